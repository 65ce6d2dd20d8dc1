"""Training-data operators: packing, licence scans, chat formatting, near-duplicate
detection, nearest neighbours, token counts, language id, quality rules, WARC, mixing."""
