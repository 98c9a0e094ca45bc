from quarry.functions.arrays import head, tail_distinct
from quarry.functions.geometry import cell_index, euclidean
from quarry.functions.strings import split_list, split_words
from quarry.functions.time import as_event_time

__all__ = [
    "head",
    "tail_distinct",
    "cell_index",
    "euclidean",
    "split_list",
    "split_words",
    "as_event_time",
]
