from sparkbrook.functions.text import joined_address, null_or_empty, strip_special

__all__ = ["joined_address", "null_or_empty", "strip_special"]
