"""Small hostile inputs shared by the tests."""

import os

DATA = os.environ.get("WEFTLINE_DATA", "/root/testdata/sf0.01")
SMALL = DATA.replace("sf0.01", "sf0.001")

WORDS = "the of and onnd ererly thhat tionble inges stedou ouhath".split()
TEXTS = [
    None, "", " ", "\n\n", "a", "The the  THE\tthe\r\nthe\x0bx\x0cy", "naïve café Ñandú ß ﬁ İstanbul ΣΑΣ é ́x  nbsp  em \x1cfs \x85nel",
    "it's don't we'll I'M 'tis rock'n'roll 1234 3.14 ²³ Ⅷ", "<|endoftext|> a<|endoftext|>b <|startoftext|>x", "日本語 テキスト 한국어 🎉👨‍👩‍👧 x", "x" * 5000, "word " * 3000,
    "same line here\nsame line here\nsame line here", "tab\there", "a\n b", "a \nb", "trailing  ", "  leading", "﻿bom", "a b", "nul\x00char",
    " ".join(WORDS[i % 10] + str(i % 7) for i in range(4000)),
]


def docs(spark, texts=TEXTS, extra=True):
    """Rows with these texts, null keys, a repeated row, and columns whose names clash with results."""
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), "x", 1.5) for i, t in enumerate(texts)]
    rows += [rows[min(5, len(rows) - 1)], (None, "no id at all", "en", "s1", 12, "x", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, score double")
    return df if extra else df.drop("n_tokens", "score")
