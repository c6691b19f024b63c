from quire.llm import copies as C
from tests.conftest import rows

SCHEMA = "vocab_id long, collection string, article string, word string, _key string, first_id string, copies int"


def table(spark, data):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in data], SCHEMA)


SAME = [
    (10, "book-a1", "die", "Haustür"),
    (11, "Book A1", "DIE", "HAUSTÜR"),
    (12, "book_a1", None, "die Haustür"),
    (13, "book-a1", "", "Haustür (die)"),
    (14, "book-a1", None, "Haustür, die"),
    (15, "book-a1", "Haustür", "die"),
    (16, "book-a1", " die.", "\t*Haus-tür* !"),
    (17, "book-a1", "die", "Haustür"),
]
OTHER = [
    (20, "book-a1", "das", "Haustür"),
    (21, "book-a2", "die", "Haustür"),
    (22, "book-a1", "die", "Haustur"),
    (23, "book-a1", None, "Haustür"),
    (24, "book-a1", "die", "Haus​tür"),
    (25, "book-a1", None, "die"),
    (26, None, None, None),
    (27, "", " ", "..."),
    (30, "book-a1", "l'", "eau"),
    (31, "book-a1", None, "l'eau"),
    (32, "book-a1", "", "eau (l’)"),
    (40, "b", "die", "Straße"),
    (41, "b", "die", "STRASSE"),
]


def test_one_entry_however_written(spark):
    df = table(spark, SAME + OTHER)
    assert rows(C.copies(df)) == [(10, k) for k in range(11, 18)] + [(26, 27), (30, 31), (30, 32), (40, 41)]
    e = rows(C.entries(df))
    assert (10, 8, 7) in e and sum(r[1] for r in e) == len(SAME) + len(OTHER)
    assert rows(C.copies(df.repartition(5))) == rows(C.copies(df.coalesce(1)))


def test_empty_and_long(spark):
    df = table(spark, [(1, "b", "der", "x" * 100_000), (2, "b", "der", "X" * 100_000)])
    assert rows(C.copies(df)) == [(1, 2)]
    assert C.copies(df.limit(0)).count() == 0 and C.entries(df.limit(0)).count() == 0


def test_a_hot_entry_keeps_every_copy(spark):
    df = table(spark, [(k, "b", "der", "Hund") for k in range(5000)] + [(9000, "B", None, "der Hund")])
    assert C.copies(df).count() == 5000 and rows(C.entries(df)) == [(0, 5001, 2)]
