"""Plain versions of the operators, and tables with every awkward row."""

import re
from collections import Counter

SPACE = re.compile(r"[\x20\x09-\x0D]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators might want for themselves.
CLASHES = "size label key part doc word print place score shard slot copies node group tie axes labels hash".split()


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in SPACE.split(ascii_lower(text or "")) if w]


def jaccard(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def prose(seed, n):
    import random

    draw = random.Random(seed)
    syllables = "an er on the sh ti or ou ing ble ha re st nd ea".split()
    return " ".join("".join(draw.choice(syllables) for _ in range(draw.randint(1, 3))) for _ in range(n))


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated ids, repeated rows, and columns whose
    names operators use themselves."""
    long_text = prose(1, 30_000)
    rows = [
        (1, prose(2, 60), "en", "a", 300),
        (2, prose(2, 60), "en", "b", 300),
        (3, prose(2, 60) + " more", None, "a", None),
        (4, None, "en", None, None),
        (5, "", "fr", "b", 0),
        (6, " \n\t ", "fr", "b", 4),
        (7, long_text, "en", "a", len(long_text)),
        (None, prose(3, 20), "en", "c", 100),
        (None, None, None, None, None),
        (8, prose(4, 20), "en", "c", 100),
        (8, prose(4, 20), "en", "c", 100),
        (8, prose(5, 20), "de", "c", 100),
        (9, "É ß 😀 | !! ###", "de", "", -3),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", *(f"'{c}' AS `{c}`" for c in CLASHES)).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
