"""Rows that every operator over documents must bear, and plain helpers."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return; as further columns of the input.
CLASHING = (
    "score predicted held_out x y votes fp rep component_id fingerprint key rid starts ends h p "
    "e block train value words start chunk item_id diagonal row domain language origin n_tokens "
    "n_copies epochs digits labels n_words kept bits gone"
).split()


def prose(seed, n):
    random.seed(seed)
    return " ".join(
        "".join(random.choice(["ba", "ko", "ri", "tu", "mé", "sol"]) for _ in range(3))
        for _ in range(n))


LONG = prose(99, 30_000)
ODD = [
    (1, prose(1, 60), "en", "src1", 10),
    (2, "", "en", "src1", 0),
    (3, None, None, None, None),
    (4, "  \t\n ", "en", "src2", 5),
    (5, prose(1, 60), "en", "src1", 10),
    (6, prose(1, 60), "en", "src1", 10),
    (6, prose(1, 60), "en", "src1", 10),
    (7, LONG, "de", "src0", 5),
    (8, "one", "fr", "src3", 3),
    (9, "One two", "fr", "src3", 7),
    (10, "a\x00b   ź 𝄞 ÀÉ", "es", "src4", 9),
    (11, "!!! ??? ...", "en", "src4", 11),
    (12, prose(12, 40) + "\n" + prose(1, 60), "en", "src1", 10),
    (None, prose(13, 30), "en", "src1", 10),
    (None, None, None, None, None),
]


def odd_documents(spark, clashing=False):
    frame = spark.createDataFrame(ODD, SCHEMA)
    for name in CLASHING if clashing else ():
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def odd_labels(spark, name):
    rows = [(1, 1), (2, 0), (2, 1), (3, None), (5, 0), (6, 0), (7, 0), (None, 1), (99, 1), (8, 1),
            (9, 0), (12, 1)]
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def collected(frame, *order):
    order = order or frame.columns
    return sorted(
        (tuple(r[c] for c in order) for r in frame.collect()), key=lambda t: tuple(map(str, t)))


def without_rows_of_columns(frame):
    """The rows as strings, to compare results whose columns are the same."""
    return collected(frame)
