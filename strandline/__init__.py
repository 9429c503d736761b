"""strandline: where passages of a known, ordered text occur in noisy timed streams.

Everything is declared with the DataFrame API.  Python runs only in Arrow
batches, and only where the state is inherently sequential (the aligner fold).
"""

__version__ = "0.1.0"
