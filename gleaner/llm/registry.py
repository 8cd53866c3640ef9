"""The training-data operators' queries by name, and their SQL where SQL can express them."""

from gleaner.llm import q_chat, q_decontaminate, q_langid, q_minhash, q_packing, q_secrets, q_sharding, q_toxicity, q_urlfilter, q_winnow

_MODULES = [q_urlfilter, q_packing, q_decontaminate, q_toxicity, q_minhash, q_secrets, q_winnow, q_chat, q_langid, q_sharding]

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
