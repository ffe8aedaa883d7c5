"""Training-data operators: URL filter, quality, dedup, extraction, decontamination,
BPE, toxicity, token counts, near-dedup and fingerprints.

Functions of this package travel to the executors by value, so a cluster needs
no copy of the package on its workers (only numpy, pyarrow and the tokenizer
file's own libraries, which are named in the README).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
