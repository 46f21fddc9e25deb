"""Text rules against a second statement of them, character by character, on generated texts."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from kinloom.functions import text
from kinloom.functions.words import COUNTRY_CODES, LEGAL_FORMS, NULL_WORDS

SIGNS = set(",;:/\\|()[]{}\"~`!@#$%^*_=?<>")
PIECES = [
    "a", "b", "zq", "Kor", "vint", "MELO", "7", "42", "é", "ü", "ñ", "ﬁ", "Ⅳ", "東", "ß", "ø", "́", "Ａ",
    " ", "  ", "\t", "\n", " ", "​", "﻿", " ", ".", "..", " . ", "-", "--", "'", " '", "&", "+", "_", ",", "(", ")", "#", "/", "?", "null", "NaN",
]


def generated(n=1500, seed=5):
    draw = random.Random(seed)
    return [None, ""] + ["".join(draw.choices(PIECES, k=draw.randint(1, 14))) for _ in range(n)]


def values(spark, cases, make):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    return [r.v for r in rows.select("i", make(F.col("c")).alias("v")).orderBy("i").collect()]


def same(spark, cases, make, rule):
    got = values(spark, cases, make)
    wrong = [(c, g, rule(c)) for c, g in zip(cases, got) if g != rule(c)]
    assert not wrong, wrong[:5]


def word(c):
    return c == "_" or unicodedata.category(c)[0] in "LN"


def at(s, i):
    return s[i] if 0 <= i < len(s) else " "


def cleaned(s, compose=True):
    s = s or ""
    if s.lower() in NULL_WORDS:
        return ""
    s = (unicodedata.normalize("NFKC", s) if compose else s).lower()
    return " ".join("".join(" " if c in "​﻿" else c for c in s).split())


def without_dots(s):
    s = "".join(c for i, c in enumerate(s) if not (c == "." and word(at(s, i - 1)) and at(s, i + 1).isspace()))
    out, i = [], 0
    while i < len(s):  # a dot between blanks goes with them; the blanks serve one dot alone
        j = i
        while at(s, j) == " " and j < len(s):
            j += 1
        k = j + 1
        while at(s, k) == " " and k < len(s):
            k += 1
        if j > i and at(s, j) == "." and k > j + 1 and j < len(s):
            out.append(" ")
            i = k
        else:
            out.append(s[i])
            i += 1
    return "".join(out)


def without_loose(s, sign):
    return "".join(" " if c == sign and not (word(at(s, i - 1)) and word(at(s, i + 1))) else c for i, c in enumerate(s))


def finished(s, signs):
    s = "".join(" " if c in signs else c for c in s)
    return " ".join(without_loose(without_loose(s, "-"), "'").split())


def name_rule(s):
    s = s.replace("&", " and ").replace("+", " and ")
    inner = lambda i: word(at(s, i - 1)) and not word(at(s, i - 2)) and word(at(s, i + 1)) and not word(at(s, i + 2))
    return finished(without_dots("".join(c for i, c in enumerate(s) if not (c == "." and inner(i)))), SIGNS)


def address_rule(s):
    return finished(without_dots(s), SIGNS | {"&"})


def alnum_rule(s):
    return " ".join("".join(c if unicodedata.category(c)[0] in "LNM" else " " for c in s).split())


def test_cleaning(spark):
    same(spark, generated(), text.clean, cleaned)


def test_names(spark):
    same(spark, generated(seed=6), lambda c: text.normal_name(text.clean(c)), lambda s: name_rule(cleaned(s)))


def test_addresses(spark):
    same(spark, generated(seed=7), lambda c: text.normal_address(text.clean(c)), lambda s: address_rule(cleaned(s)))


def test_alphanumeric_forms_are_of_the_normal_form_normalised_again(spark):
    again = lambda rule: lambda s: alnum_rule(rule(cleaned(rule(cleaned(s)), False)))
    dotted = generated(seed=8) + [f"{a}.{b}{c}{d}" for a in "xy_ " for b in "pq" for c in "/_.-" for d in ("", "r", ".s", ".t.u")]
    same(spark, dotted, lambda c: text.alnum_name(text.normal_name(text.clean(c))), again(name_rule))
    same(spark, dotted, lambda c: text.alnum_address(text.normal_address(text.clean(c))), again(address_rule))


def core_rule(s):
    """Legal forms go from the end, the longest that fits first, while blanks or hyphens are before them."""
    rest = s
    while True:
        ends = [f for f in LEGAL_FORMS if rest.endswith(f) and rest[: -len(f)].endswith((" ", "-"))]
        if not ends:
            break
        rest = rest[: -max(map(len, ends))].rstrip(" -")
    return rest.strip(" -") or s


def test_cores(spark):
    draw = random.Random(9)
    words = ["orlo", "vanta", "quill", *draw.sample(LEGAL_FORMS, 12)]
    cases = [" ".join(draw.choices(words, k=draw.randint(1, 4))) for _ in range(400)] + ["orlo-gmbh", "gmbh", ""]
    same(spark, cases, text.name_core, core_rule)


def test_countries(spark):
    cases = [shape.format(n) for n in COUNTRY_CODES for shape in ("{}", " ({}) ", "{}.", "{},")] + ["Atlantis", "", None, "NONE"]
    same(spark, cases, lambda c: text.normal_country(text.clean(c)), lambda s: COUNTRY_CODES.get((s or "").strip(" (),."), COUNTRY_CODES.get((s or "").strip(" (),").replace("..", "."), "" if s in (None, "", "NONE") else "atlantis")))


def test_tokens(spark):
    runs = lambda s, keep: "".join(c if keep(c) else " " for c in s).split()
    once = lambda x: list(dict.fromkeys(x))
    cases = [cleaned(s) for s in generated(seed=10)]
    same(spark, cases, text.word_tokens, lambda s: runs(s, word))
    same(spark, cases, text.blank_tokens, lambda s: once(s.split(" ")) if s else [])
    same(spark, cases, text.trigrams, lambda s: once(s[i : i + 3] for i in range(len(s) - 2)))
    same(spark, cases, text.number_tokens, lambda s: once(w for w in runs(s, word) if all(unicodedata.category(c) == "Nd" for c in w)))


@pytest.mark.parametrize("mode", ["strict", "lenient", "prefix", "underscore"])
def test_target_source(spark, mode):
    def rule(s):
        low = s.lower()
        for k in ("2", "3"):
            starts = low.startswith((f"s{k}_", f"s{k}-"))
            said = {
                "strict": starts or f"_s{k}_" in low, "lenient": k == "2" and (starts or "_s2_" in low),
                "prefix": k == "2" and starts and len(s) > 3, "underscore": low.startswith(f"s{k}_"),
            }[mode]
            if said:
                return f"Source {k}"
        return "Source 3" if mode in ("lenient", "prefix") else "Unknown"

    parts = ["s2", "S3", "s1", "zz", "_", "-", "9", ""]
    same(spark, ["".join((a, b, c, d)) for a in parts for b in parts for c in parts for d in parts], lambda c: text.target_source(c, mode), rule)


def test_cell_kinds(spark):
    cells = {None: "null", "NULL": "null", "None": "null", "Null": "valid", "": "empty", " \x1f": "whitespace", " \t": "whitespace", "0": "valid"}
    same(spark, list(cells), text.cell_kind, cells.__getitem__)
