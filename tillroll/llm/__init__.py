"""Training-data operators: quality, de-duplication, decontamination, PII,
secrets, tokenisation, sharding and chat formatting.

Nothing outside this package imports it; queries are collected in
``tillroll.llm.queries``.
"""
