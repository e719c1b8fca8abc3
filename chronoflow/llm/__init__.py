"""Operators for training data. Nothing outside this package imports it.

``MODULES`` names the modules that hold queries.
"""

MODULES = ("q_topn", "q_truncation", "q_capping", "q_neardup", "q_residue", "q_encoding", "q_mojibake", "q_packing", "q_splitting")
