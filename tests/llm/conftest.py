from __future__ import annotations

import pytest

#: Columns that the operators also use inside, to see that they do not clash.
CLASHING = dict(digest="x", row=7, key="k", words="w", hits=0, score=0.5, bucket=3, block="b", start=1, gram="g", print=9, label=1, hash=5, n=2, _row=100, _id=1, _removed="r", _key="y", _hits=6, _gone=8)
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, row int, key string, words string, "
    "hits int, score double, bucket int, block string, start int, gram string, print int, label int, hash int, n int, "
    "_row int, _id int, _removed string, _key string, _hits int, _gone int"
)


def docs_of(spark, texts, partitions=3):
    """A frame of (doc_id, text) with clashing extra columns, dealt over several partitions."""
    rows = [(i, t, None, None, None, *CLASHING.values()) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).coalesce(partitions)


PASSAGE = (
    "A passage of more than fifty words, which goes on for some time. It has several sentences. Some of them are short. "
    "Others are somewhat longer and hold a subordinate clause, as this one does, before they end. Then there is one more, "
    "so that the whole is well above the number of words that is asked for here."
)


@pytest.fixture(scope="session")
def hard_texts():
    """Nulls, empty and long texts, ties and repeated rows."""
    return [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today."),
        (2, None),
        (3, ""),
        (4, "   \n\t "),
        (5, "word " * 30_000),
        (6, "x" * 50_000),
        (7, "The quick brown fox jumps over the lazy dog near the old river bank today."),
        (7, "The quick brown fox jumps over the lazy dog near the old river bank today."),
        (None, "The quick brown fox jumps over the lazy dog near the old river bank today."),
        (None, None),
        (8, "Ünï çödé 日本語 😀 it's  we'll\r\n\x00 ok"),
        (9, "one two"),
        (10, f"Before. {PASSAGE} After."),
        (11, f"Something else here. {PASSAGE} And more of it."),
    ]
