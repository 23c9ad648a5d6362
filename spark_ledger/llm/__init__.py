"""Training-data pipeline operators (near-dedup, quality, packing, tokens).

Nothing outside this folder imports it; ``queries`` registers one query per
operator.
"""
