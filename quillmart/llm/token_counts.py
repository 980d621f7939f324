"""Token counts of documents (operator 1).

Rank-synchronous array merging (``bpe.RankMerger``): per batch of documents
the distinct new pre-tokens are held as one ragged array, each applies its
lowest-rank pair at once, and the surviving symbols are counted. One narrow
map stage, no shuffle.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null id
stays null; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillmart.llm.bpe import WordCounter, shared
from quillmart.llm.common import map_batches, text_rows

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: UTF-8 bytes, tokens under ``vocabulary`` (a
    ``tokenizers`` BPE file with word ends, present on every executor) and
    whether the tokens exceed ``limit``."""

    def make():
        counter = shared(WordCounter, vocabulary)

        def run(c: dict) -> dict:
            n = counter.count(c["text"])
            return {"doc_id": c["doc_id"], "n_bytes": [len(t.encode()) for t in c["text"]],
                    "n_tokens": n, "over_limit": n > limit}

        return run

    return map_batches(text_rows(docs, id_col, text_col), make, SCHEMA)
