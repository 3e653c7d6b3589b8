"""Training-data operators: language ID, dedup, joins, search, tokenisation, chat, HTML, mixing.

Nothing outside this subpackage imports it.
"""
