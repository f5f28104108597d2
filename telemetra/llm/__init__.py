"""Training-data operators: deduplication, sharding, mixing, tokenising, filtering and scoring.

Every operator is a function of DataFrames that keeps its own module; the
registered queries over ``documents`` are in :mod:`telemetra.llm.queries`.
Nothing outside this package imports it.
"""
