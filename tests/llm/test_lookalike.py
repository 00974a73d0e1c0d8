import unicodedata

from pyspark.sql import functions as F

from cabstrata.llm import lookalike

SAME = [
    ("Ｈｅｌｌｏ，　ｗｏｒｌｄ！", "Hello, world!"), ("café", "cafe\u0301"), ("pay\u200bpal\ufeff", "paypal"), ("a\u00a0b\u2009c\td", "a b c d"), ("раypal", "paypal"), ("ﬁnal oﬃce", "final office"),
    ("cо\u0301rdoba", "córdoba"), ("Всё", "Bcë"), ("soft\u00adhyphen", "softhyphen"), ("taxi\ufe0f", "taxi"), ("line\r\nbreak", "line\nbreak"), ("Ό", "Ó"), ("ї", "ï"),
    ("non\u2011breaking", "non-breaking"), ("hy\u2010phen", "hy-phen"), ("Ⅻ ⅳ Ⅿ", "XII iv M"), ("ﾀﾞｲﾔ", "ダイヤ"), ("５￠", "5¢"), ("ᎪᏢᏢᏞᎬ", "APPLE"), ("ꓡꓲꓢꓴ", "LISU"), ("ⲢⲟⲢ", "PoP"), ("ﬅ", "ſt"), ("⽇⽊", "日木"),
    ("pay\u200dpal\u200c", "paypal"), ("en\u200d\u200dgin\u200c\u200de", "engine"), ("a\u200e b", "a b"), ("\u202dplain\u202c", "plain"), ("😀\ufe0f", "😀"), ("🚕\u200d🌧\ufe0f", "🚕🌧\ufe0f"), ("بب", "ب\u200dب"), ("ا\u200cب", "اب"), ("\u200cسلام\u200c", "سلام"),
]
OTHER = [
    ("a  b", "a b"), ("a\nb", "a b"), ("Hello", "hello"), ("café", "cafe"), ("a,b", "a;b"), ("a b", "ab"), ("don’t", "don't"), ("x²", "x2"), ("word", "words"), ("日本", "日"),
    # Joiners, selectors and directions that show.
    ("می\u200cخواهم", "میخواهم"), ("👨\u200d👩\u200d👧", "👨👩👧"), ("❤\ufe0f\u200d🔥", "❤🔥"), ("🏃🏽\u200d♀\ufe0f", "🏃🏽♀\ufe0f"), ("\u202etxt.exe", "txt.exe"), ("ه\u200d", "ه"), ("क्\u200dष", "क्ष"), ("क्\u200cष", "क्ष"), ("❤\ufe0f", "❤"), ("שלום\u200e!", "שלום!"),
    ("ſt", "st"), ("①", "1"), ("𝐀", "A"), ("ﾀ", "た"), ("–", "-"),
]


def forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({"form": F.lit("clash"), "raw": F.lit(1), "rows": F.lit(2)})
    return df, {r.doc_id: r.canonical for r in lookalike.canonical_texts(df, "doc_id", "text").collect()}


def test_same_and_other(spark):
    _, got = forms(spark, [t for p in SAME + OTHER for t in p])
    for i, (a, b) in enumerate(SAME + OTHER):
        assert (got[2 * i] == got[2 * i + 1]) is ((a, b) in SAME), (a, b, got[2 * i], got[2 * i + 1])


def test_generated_confusables_are_all_found(spark):
    """For every compatibility form of the classes by rule, whatever its block, a text with it and one with
    what its normal form shows: all come out equal. Of what looks different none does."""
    same, other = [], []
    for cp in range(0x80, 0x20000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        name, nfkc = unicodedata.name(c, ""), unicodedata.normalize("NFKC", c)
        if name.startswith(("FULLWIDTH", "HALFWIDTH")) and not any(x in name for x in ("FILLER", "HANGUL", "MACRON")) or "ROMAN NUMERAL" in name and len(nfkc) < 5 and nfkc.isascii() or name.startswith("KANGXI RADICAL") or name.startswith("LATIN SMALL LIGATURE F"):
            same += [f"x {c} y", f"x {nfkc} y"]
        elif name.startswith(("SUPERSCRIPT", "SUBSCRIPT", "CIRCLED", "MATHEMATICAL BOLD", "PARENTHESIZED")) and nfkc != c:
            other += [f"x {c} y", f"x {nfkc} y"]
        elif name.startswith(("GREEK SMALL LETTER", "CYRILLIC SMALL LETTER", "GREEK CAPITAL LETTER", "CYRILLIC CAPITAL LETTER")) and len(d := unicodedata.normalize("NFD", c)) > 1:
            same += [c, "".join(lookalike.LOOKALIKES.get(x, x) for x in d)]
    _, got = forms(spark, same + other)
    n = len(same)
    missed = [(same[i], same[i + 1]) for i in range(0, n, 2) if got[i] != got[i + 1]]
    assert n > 1400 and not missed, (len(missed), missed[:20])
    assert len(other) > 300 and not [i for i in range(n, n + len(other), 2) if got[i] == got[i + 1]]


def test_many_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(lookalike, "PAIRED_AT_ONCE", 3)
    df, _ = forms(spark, ["same", "sаme"] * 8 + ["other"])
    pairs = [tuple(r) for r in lookalike.lookalike_pairs(lookalike.canonical_texts(df, "doc_id", "text", hashed=True), "doc_id").collect()]
    assert len(pairs) == len(set(pairs)) == 64 and set(pairs) == {(a, b) for a in range(16) for b in range(a + 1, 16) if (b - a) % 2}


def test_canonical_form_is_stable_and_composed(spark):
    texts = [t for p in SAME + OTHER for t in p]
    _, once = forms(spark, texts)
    _, twice = forms(spark, [once[i] for i in range(len(texts))])
    assert once == twice and all(unicodedata.is_normalized("NFC", t) for t in once.values())


def test_pairs_and_classes(spark):
    long = "x" * 60_000
    texts = ["paypal", "pаypal", "paypal", "pay​pal", None, "", " 　", "​", "other", long + "ο", long + "o", None]
    df, _ = forms(spark, texts)
    f = lookalike.canonical_texts(df, "doc_id", "text", hashed=True)
    pairs = {tuple(r) for r in lookalike.lookalike_pairs(f, "doc_id").collect()}
    assert pairs == {(0, 1), (1, 2), (0, 3), (2, 3), (1, 3), (9, 10)}
    assert {(r.doc_id, r.class_id) for r in lookalike.document_classes(f, "doc_id").collect()} == {(0, 0), (1, 0), (2, 0), (3, 0), (4, None), (5, None), (6, None), (7, None), (8, 8), (9, 9), (10, 9), (11, None)}
    empty = lookalike.canonical_texts(df.limit(0), "doc_id", "text", hashed=True)
    assert lookalike.lookalike_pairs(empty, "doc_id").count() == 0 and lookalike.document_classes(empty, "doc_id").count() == 0


def test_tables():
    assert all(len(k) == 1 == len(v) for k, v in lookalike.LOOKALIKES.items()) and len(lookalike.LOOKALIKES) < 200
    assert not set(lookalike.LOOKALIKES) & set(lookalike.LOOKALIKES.values())
