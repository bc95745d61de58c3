import os
import random
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, size string, hashes string, component string"
WORDS = "the of and to in is that it for was on are with as his they at be this from have or by one had not but what all were when".split()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, n):
    """Invented prose of ``n`` words; every second word is rare."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        out.append(r.choice(WORDS) if k % 2 else "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4))))
        if k % 13 == 12:
            out[-1] += ".\n" if k % 39 == 38 else "."
    return " ".join(out).replace("\n ", "\n")


def frame(spark, rows, schema=SCHEMA):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns whose names
    clash with those the operators make."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 0.5, "x", "y", "z", "c") for r in rows]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    a, b = prose(1, 120), prose(2, 90)
    rows = [
        (1, a), (2, a), (3, b), (3, b), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "two words"),
        (9, prose(3, 40000)), (None, a), (None, None), (10, "x" * 50000), (11, a + "\n" + b), (12, "é ü 猫 " * 30), (13, b.upper()),
    ]
    return frame(spark, [(*r, None if k % 5 == 4 else f"s{k % 3}") for k, r in enumerate(rows)])


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
