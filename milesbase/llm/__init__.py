"""Training-data operators (quality, dedup, search, packing, archives, tokenizing).

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds
``QUERIES`` / ``ORACLES`` of ``milesbase.llm.plans`` when it can be imported.
"""
