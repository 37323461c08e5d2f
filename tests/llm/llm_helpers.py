"""Small inputs shared by the tests of this folder."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, k long, n int, class string, "
          "comp string, _t string, size string, key string, c string, share string, ll string, host string")


def prose(rng, n, vocabulary=400, lang="en"):
    common = {"en": "the of and to in is that for with as", "de": "der die und in den von zu das mit sich",
              "fr": "le la de et les des en un une du", "es": "el la de que y en un los se por"}[lang].split()
    end = {"en": "ing", "de": "ung", "fr": "eux", "es": "ado"}[lang]

    def word():
        if rng.random() < 0.4:
            return rng.choice(common)
        v = rng.randrange(vocabulary)
        return "bcdfglmnprst"[v % 12] + "aeiou"[v % 5] + "klmnrst"[v % 7] + "aeiou"[v // 60 % 5] + "bdgkmpt"[v // 300 % 7] + end
    return " ".join(word() for _ in range(n))


def make_docs(spark, rows):
    """Rows (doc_id, text[, lang, source]) with extra columns whose names clash with internal ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, "x", 1, 2, "c", "d", "t", "z", "y", "q", "u", "v", "w")
            for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_texts():
    """Copies, near copies, short, empty, null, long and odd texts."""
    rng = random.Random(5)
    base = [prose(rng, n, 3000) for n in (60, 80, 120, 200, 300, 40, 30, 25)]
    out = [*base, base[2], base[2], base[4].upper()]
    for i in range(12):
        words = base[3].split()
        for j in rng.sample(range(200), i % 4):
            words[j] = f"edit{i}x{j}"
        out.append(" ".join(words))
    return [*out, "", None, "   \n\t ", "one", "One", "one two three", "one two three four five",
            "two  spaces here  and\nlines\n\nmore ", "a b c a b c a b c a b c", "same line\nsame line\nother\nsame line",
            "été où ça — naïve 日本語 ✓ text", None, "", "### $$$ ***", " ".join(["word"] * 70),
            prose(rng, 9000, 5000), "x" * 5000, "tab\tand\x0bfeed\x0cand\rreturn <|endoftext|> it's we'll  nbsp  wide"]
