"""Training-data operators: packing, deduplication, WARC, tokenizers, language
identification, vector search and chat formatting.

Nothing outside this package imports it. ``wagegrid.llm.entry`` holds the
registered queries and their SQL.
"""
