"""Documents with what operators have to take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns under names that operators use themselves.
CLASHES = ("n_words", "node", "found", "fail_bits", "items", "copies", "p", "n")


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("ta", "re", "mi", "öl", "sun", "Bo", "kü", "ne", "a", "ver") for b in ("lo", "na", "ti", "us", "en", "ß", "er", "in", "go", "st") for _ in range(4)][:vocabulary]
    return " ".join(r.choice(words) + r.choice(("", "", "", ",", ".", "\n")) for _ in range(n))


def edited(text, seed, share=0.02):
    r = random.Random(seed)
    return " ".join(w + "x" if r.random() < share else w for w in text.split(" "))


def rows():
    base, passage = prose(1, 160), prose(2, 120)
    texts = [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, "word"),
        (5, base),
        (6, base),
        (6, base),
        (7, edited(base, 7)),
        (8, edited(base, 8)),
        (9, edited(edited(base, 8), 9)),
        (10, prose(10, 60) + "\n" + passage + "\n" + prose(11, 60)),
        (11, prose(12, 60) + "\n" + passage + "\n" + prose(13, 40)),
        (12, "same line here\n" * 60),
        (13, "a" * 1500),
        (14, "Released under the MIT License. MIT license, Apache License; GNU General Public License\nLicensed under CC BY-NC 4.0."),
        (15, "mail a.b@mail.example.com%x@y.org or +1 (202) 555-0143, card 4111 1111 1111 1111 from 10.0.0.255 not 10.0.0.256 nor 1.2.3.4.5"),
        (16, prose(16, 30) + " four five six seven"),
        (17, "one two three four"),
        (18, "One TWO three four"),
        (19, prose(19, 200) + "### a*** | b &&& <p> " * 60),
        (20, "K" + "İ mıt license MİT LICENSE mit\x00license"),
        (None, prose(21, 40)),
        (None, None),
        (22, prose(22, 9) + " " + " ".join(["again and again the same eight words come"] * 9)),
        (23, "1" * 3000 + " " + "-".join("1" * 3000) + " a@" + ".".join("b" * 3000)),
    ]
    sources = ["b", "a", None, "b", "ü", "Z"]
    return [(i, t, "en", sources[k % len(sources)], len(t) if t is not None else None) for k, (i, t) in enumerate(texts)]


def frame(spark, given=None, clash=True):
    df = spark.createDataFrame(rows() if given is None else given, SCHEMA)
    return df.withColumns({c: _lit("kept " + c) for c in CLASHES}) if clash else df


def _lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


BENCHMARK = [
    (1, prose(16, 30)),
    (2, "four, FIVE six"),
    (3, None),
    (4, " ... "),
    (None, prose(10, 30)),
    (5, prose(2, 40)),
    (5, "seven"),
]
