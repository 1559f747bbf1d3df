import pytest

LONG = " ".join(f"word{i % 997} filler{i}" for i in range(20_000))
COMMON = "This line of more than forty characters is in many documents."

ODD = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, "  \n\t \n", "en", None),
    (4, "one two", "en", "a"),
    (5, LONG, "en", "b"),
    (5, LONG, "en", "b"),  # a repeated row
    (6, LONG, "en", "b"),
    (7, "x" * 300_000, "en", "b"),  # no blank at all
    (None, "A text without an id, long enough to pass the base rules of quality here.", None, None),
    (8, "same words again " * 12, "en", "a"),
    (9, "Übergrößen naïve café 北京大学 emoji 😀😀 nbsp here \x85 ideographic　blank  two  blanks ", "de", "c"),
    *[(10 + i, f"own line {i}\n{COMMON}\n  {COMMON.upper()} \nlast line {i}\n", "en", "hot") for i in range(7)],
    (20, "Don't   stop\r\n'sfoo we'll\tsee <|endoftext|> it's 123abc !!??\x00 ok", "en", "c"),
    (21, "Tie one two three four five six seven eight nine ten.", "en", "c"),
    (22, "Tie one two three four five six seven eight nine ten.", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows of all awkward kinds, with further columns named like those operators add."""
    rows = [(i, t, lang, s, len(t or ""), None, "x", 1, {"k": "v"}) for i, t, lang, s in ODD]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, kept string, fingerprint string,"
        " row int, whole map<string,string>"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def documents(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, tables):
    return spark.read.parquet(f"{tables}/labels.parquet")


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(4, 0, None), (5, 1, 0), (5, 0, 0), (None, 1, 1), (21, None, 0), (22, 1, 0), (999, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
