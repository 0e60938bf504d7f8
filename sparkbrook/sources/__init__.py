from sparkbrook.sources.files import read_csv, read_json, stream_json
from sparkbrook.sources.store import TableStore, write_path

__all__ = ["TableStore", "read_csv", "read_json", "stream_json", "write_path"]
