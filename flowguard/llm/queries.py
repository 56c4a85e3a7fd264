"""Every operator module of this subpackage, imported so that its query is registered."""

from flowguard.llm import (  # noqa: F401
    ann,
    chat,
    decontaminate,
    jaccard,
    language,
    mixing,
    phrases,
    sharding,
    token_cache,
    topk,
    url_rules,
    vector_codes,
    warc,
)
from flowguard.llm.registry import ORACLES, QUERIES


def load() -> tuple[dict, dict]:
    return QUERIES, ORACLES
