"""Small tables that every operator must get through."""

import random

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as the input's own columns.
CLASHES = ("size", "shard", "slot", "h", "sig", "id", "task", "n", "body", "base", "near", "uid", "bit", "score", "target",
           "source_size", "taken_copies", "piece", "start", "length", "label", "rank", "v", "spans", "__id", "terms", "gone", "words", "lines", "hashes", "failed", "term", "ordinal", "total", "block", "at",
           "pair", "key")


def prose(seed, words=120, vocabulary=400):
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(made) for _ in range(words))


def documents(spark, texts, sources=None):
    rows = [
        (i, t, "en", None if sources is None else sources[i], None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def edge_texts():
    base = prose(1)
    near = base.split()
    near[60] = "changed"
    return [
        None, "", " \n\t ", "one", "two words", base, base, " ".join(near), base.upper(), "é" * 3000 + " 漢字 " * 500,
        "a " * 20_000, "x" * 50_000, prose(2, 9_000), "mail me at jo.doe@mail.example.com or +1 (212) 555-0187 now",
        "ip 10.0.0.255 and 999.1.1.1 card 4539 1488 0343 6467", "\0 \x1c   nul", "<|endoftext|> is text", "1" * 5_000,
        prose(3, 5), prose(3, 4),
    ]


def edge_documents(spark):
    """Nulls in every column, odd texts, repeated rows and clashing columns."""
    texts = edge_texts()
    rows = [(i, t, None if i % 4 == 0 else "en", [None, "a", "b"][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "en", "a", None)] * 2
    rows += [(None, texts[5], None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
