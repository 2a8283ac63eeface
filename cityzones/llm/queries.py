"""Queries and SQL of the operators of this subpackage, by query name."""

from __future__ import annotations

from cityzones.llm import (
    chat, decontaminate, html_blocks, importance, licenses, minhash, mixing, quality, runs, secrets, sharding, suffixes,
    token_files)

_MODULES = (decontaminate, chat, minhash, quality, mixing, sharding, suffixes, licenses, token_files, secrets,
            html_blocks, importance, runs)


def _pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()} | {"pipeline": _pipeline}
ORACLE = {k: s for m in _MODULES for k, s in m.ORACLE.items()}
