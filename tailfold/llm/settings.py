"""Production parameters of the registered queries and the pipeline."""

# Mixing: parts per source; all other sources share MIX_REST_PARTS.
MIX_PARTS = {"src0": 5, "src1": 3, "src2": 3, "src3": 2, "src4": 2, "src5": 1}
MIX_REST_PARTS = 9
MIX_BLOCK_DOCS = 8
MIX_SEED = 17
