"""Training-data pipeline operators (WARC, chat, near-duplicates, mixing, quality,
packing, token files, vector search, language id).  Nothing outside imports this."""
