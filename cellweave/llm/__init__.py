"""Operators for preparing text corpora: token counts, packing, near duplicates, licences, chats, languages, quality."""
