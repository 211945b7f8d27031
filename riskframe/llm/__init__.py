"""Training-data operators (quality, fingerprints, packing, URL filters, mixing,
token counts, nearest neighbours, near duplicates, language ID, line dedup).

Nothing outside this subpackage imports it.  Each operator is one module;
``queries`` registers one query per operator over whole tables.
"""
