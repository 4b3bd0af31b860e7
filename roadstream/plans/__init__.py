"""Plan shapes shared by the operators: how rows are split, folded and joined."""

from roadstream.plans.copies import fold_copies, unfold_copies
from roadstream.plans.dimensions import fits_broadcast, join_dimension, one_per_key
from roadstream.plans.lineage import cut_lineage, shared_folder, working_folder
from roadstream.plans.timeblocks import in_blocks

__all__ = [
    "cut_lineage",
    "fits_broadcast",
    "fold_copies",
    "in_blocks",
    "join_dimension",
    "one_per_key",
    "shared_folder",
    "unfold_copies",
    "working_folder",
]
