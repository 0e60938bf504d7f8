from sparkbrook.operators.chain import Step, run_chain
from sparkbrook.operators.clean import (
    combine_address,
    fill_defaults,
    fill_nulls,
    lowercase_strings,
    stamp_time,
    strip_columns,
)
from sparkbrook.operators.shape import explode_records, flatten
from sparkbrook.operators.split import Split, multiset_difference, split_required

__all__ = [
    "Split",
    "Step",
    "combine_address",
    "explode_records",
    "fill_defaults",
    "fill_nulls",
    "flatten",
    "lowercase_strings",
    "multiset_difference",
    "run_chain",
    "split_required",
    "stamp_time",
    "strip_columns",
]
