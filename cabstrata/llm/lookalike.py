"""One form for texts that look the same, by DuckDB inside Arrow partitions.

The embedded SQL removes what shows nothing, maps blanks, full-width and other compatibility forms and
look-alike letters, and composes accents. Letter case, accents, punctuation, words and the number of
blanks and line breaks stay, and so do joiners, variation selectors and directional controls where they
show: joiners between letters that join or in emoji sequences, selectors behind what has another
presentation, controls in text that runs from right to left.

Classes of characters come from Unicode's properties by rule; only the look-alike letters are a table.
A step runs on those texts only that hold one of its characters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstrata.operators.sizing import lookup_join
from cabstrata.session import materialize

# Code points that show nothing wherever they stand. Line breaks and tabs aren't among them.
NOTHING = (
    r"\x{00}-\x{08}\x{0E}-\x{1F}\x{7F}-\x{84}\x{86}-\x{9F}\x{AD}\x{34F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{200B}\x{2060}-\x{2065}"
    r"\x{206A}-\x{206F}\x{3164}\x{FEFF}\x{FFA0}\x{FFF9}-\x{FFFB}\x{1D173}-\x{1D17A}\x{E0000}\x{E0001}"
)
# Blanks of any width.
BLANKS = r"\x{09}\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
# Marks and controls of direction; of these the ones that turn text by themselves.
DIRECTIONAL, TURNING = r"\x{61C}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2066}-\x{2069}", r"\x{202B}\x{202E}\x{2067}"
# Letters that look like a Latin one, by script, and the Latin ones in the same order.
LOOKALIKE_LETTERS = [
    # Latin
    ("ɑɡıⱭꞬ", "agiAG"),
    # Cyrillic
    ("АВЕЅІЈКМНОРСТУХаеѕіјорсухҺһԀԁԚԛԜԝҮүӏӀԌѵѴӕӔ", "ABESIJKMHOPCTYXaesijopcyxhhddQqWwYylIGvVæÆ"),
    # Greek
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορϲϳϹͿ", "ABEZHIKMNOPTYXaivopcjCJ"),
    # Armenian
    ("ՕօհոսցզՏԼՍյ", "OohnugqSLUj"),
    # Cherokee
    ("ᎠᎡᎢᎥᎪᎫᎬᏃᎳᎷᎻᎽᏀᏂᏎᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiAJEZWMHYGh4bRWSVSLCPKdGB"),
    # Lisu
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    # Coptic
    ("ⲎⲒⲔⲘⲚⲞⲟⲢⲣⲤⲥⲦⲨⲬⲭ", "HIKMNOoPpCcTYXx"),
    # Hyphens
    ("‐", "-"),
]
LOOKALIKES = {a: b for letters, latin in LOOKALIKE_LETTERS for a, b in zip(letters, latin, strict=True)}
# Emoji that a joiner makes one picture with the next, whatever that is; those that it joins to
# whatever stands before them; and the firsts and seconds of other pairs. Others stay side by side.
PEOPLE, SIGNS = "👦👧👨👩🧑", "♀♂⚧➡"
FIRSTS, SECONDS = "❤🏳🏴🐕🐈🐻🐦👁😮😵😶🍋🍄⛓🙂", "🔥🩹💋🌈☠🦺⬛❄🗨💨💫🌫🟩🟫💥↔↕👦👧👨👩🧑"
#: Documents of one form that one task pairs with all others of it.
PAIRED_AT_ONCE = 1000


@lru_cache(1)
def _alphabet() -> str:
    """All code points of the planes with scripts and symbols, surrogates left out."""
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)]))


def code_points(prop: str) -> list[int]:
    """The code points of a Unicode property."""
    return list(map(ord, regex.findall(rf"\p{{{prop}}}", _alphabet())))


def char_class(points: Iterable[int]) -> str:
    """The inside of a regular expression's class, as ranges."""
    out, run = [], []
    for cp in [*sorted(set(points)), -1]:
        if run and cp != run[-1] + 1:
            out.append(rf"\x{{{run[0]:X}}}" + (rf"-\x{{{run[-1]:X}}}" if len(run) > 1 else ""))
            run = []
        run.append(cp)
    return "".join(out)


def same_shape(ch: str) -> str | None:
    """By rule, what a compatibility form shows: full- and half-width forms, non-breaking forms, ligatures and
    digraphs of letters, Roman numerals, and radicals that are ideographs. One step of decomposition:
    the parts keep their own shapes. Superscripts, circled, mathematical, long-s and similar forms look
    different and have none."""
    tag, *parts = unicodedata.decomposition(ch).split() or [""]
    if not tag.startswith("<"):
        return None
    to = "".join(chr(int(p, 16)) for p in parts)
    if tag in ("<wide>", "<narrow>", "<noBreak>"):
        return to
    if tag != "<compat>":
        return None
    cp = ord(ch)
    letters = all(unicodedata.category(x)[0] == "L" for x in to)
    joined = len(to) > 1 and letters and unicodedata.category(ch) in ("Lu", "Ll", "Lt")
    return to if joined or (0x2160 <= cp <= 0x217F and letters) or 0x2E80 <= cp <= 0x2FD5 else None


@lru_cache(1)
def shapes() -> dict[str, str]:
    """Every compatibility form with its shape; blanks and what shows nothing are treated apart."""
    apart = regex.compile(f"[{_plain(NOTHING + BLANKS)}]")
    return {chr(cp): to for cp in range(0x80, 0x20000) if not 0xD800 <= cp < 0xE000 and (to := same_shape(chr(cp))) and not apart.match(chr(cp))}


def _plain(c: str) -> str:
    """A class of RE2 in the syntax of regex."""
    return regex.sub(r"\\x\{([0-9A-F]+)\}", lambda m: rf"\U{int(m[1], 16):08X}", c)


@lru_cache(1)
def accented_lookalikes() -> dict[str, str]:
    """By rule: the accented letters of other scripts whose base letter looks like a Latin one, as that
    letter with the same accents. Without it a look-alike before a combining accent would be composed into
    a letter of its own script and escape the table."""
    out = {}
    for cp in [*range(0x0370, 0x0530), *range(0x1F00, 0x2000)]:
        base, *marks = unicodedata.normalize("NFD", chr(cp))
        if marks and base in LOOKALIKES:
            out[chr(cp)] = unicodedata.normalize("NFC", LOOKALIKES[base] + "".join(marks))
    return out


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _replaced(x: str, table: dict[str, str]) -> str:
    """translate for single characters, replace for those that become several."""
    one = {k: v for k, v in table.items() if len(v) == 1}
    for k, v in table.items():
        if len(v) > 1:
            x = f"replace({x}, {_literal(k)}, {_literal(v)})"
    return f"translate({x}, {_literal(''.join(one))}, {_literal(''.join(one.values()))})" if one else x


def _strip(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def _joiners(x: str) -> str:
    """Keeps a joiner (as a noncharacter for the while) where it shows, removes the others."""
    joins, after = char_class(code_points("jt=D") + code_points("jt=L")), char_class(code_points("jt=D") + code_points("jt=R") + [cp for cp in code_points("jt=C") if cp != 0x200D])
    marks, virama = char_class(cp for cp in code_points("jt=T") if 0x300 <= cp < 0x1900 and not 0x1800 <= cp < 0x1810), char_class(cp for cp in code_points("Mn") if unicodedata.combining(chr(cp)) == 9)
    picture, dress = char_class(cp for cp in code_points("Extended_Pictographic") if cp > 0xFF), r"\x{FE0F}\x{1F3FB}-\x{1F3FF}"
    marks = rf"[{marks}]*?"
    x = _strip(x, rf"([{virama}])\x{{200D}}", "\\1\ufdd0")
    x = _strip(x, rf"([{virama}])\x{{200C}}", "\\1\ufdd1")
    for _ in range(2):  # neighbours share a character
        for first, second in ((PEOPLE, picture), (picture, SIGNS), (FIRSTS, SECONDS)):
            x = _strip(x, rf"([{first}][{dress}]*)\x{{200D}}([{second}])", "\\1\ufdd0\\2")
        x = _strip(x, rf"([{joins}]{marks})\x{{200C}}([{after}])", "\\1\ufdd1\\2")
        x = _strip(x, rf"([{joins}]{marks})\x{{200D}}+([{after}])", r"\1\2")
    x = _strip(x, rf"([{joins}]{marks})\x{{200D}}", "\\1\ufdd0")
    x = _strip(x, rf"\x{{200D}}([{after}])", "\ufdd0\\1")
    x = _strip(x, r"[\x{200C}\x{200D}]", "")
    return f"translate({_strip(x, r'\x{FE0F}+' + chr(0xFDD0), chr(0xFDD0))}, '\ufdd0\ufdd1', '\u200d\u200c')"


def _selectors(x: str) -> str:
    """Keeps a variation selector behind a character that has another presentation, removes the others."""
    pictures = set(code_points("Emoji_Presentation"))
    texts = {cp for cp in code_points("Emoji") if cp > 0xFF or cp in (0xA9, 0xAE)} - pictures
    x = _strip(x, rf"(^|[^{char_class(texts)}])\x{{FE0F}}+", r"\1")
    x = _strip(x, rf"(^|[^{char_class(pictures)}])\x{{FE0E}}+", r"\1")
    x = _strip(x, r"(^|[^\p{Han}\p{Sm}\p{Mongolian}\p{Myanmar}])[\x{FE00}-\x{FE0D}\x{E0100}-\x{E01EF}\x{180B}-\x{180D}\x{180F}]+", r"\1")
    return _strip(x, r"(^|[^\x{1F3F4}\x{E0020}-\x{E007F}])[\x{E0020}-\x{E007F}]+", r"\1")


@lru_cache(1)
def steps() -> list[tuple[str, str]]:
    """(class of the characters it is for, SQL of x) of each step, in order."""
    forms, accented = shapes(), accented_lookalikes()
    letters = LOOKALIKES | accented
    right_to_left = char_class(cp for cp in range(0x590, 0x1F000) if not 0xD800 <= cp < 0xE000 and unicodedata.bidirectional(chr(cp)) in ("R", "AL"))
    return [
        (r"\x{0D}", "replace(replace(x, chr(13) || chr(10), chr(10)), chr(13), chr(10))"),
        (BLANKS, _strip("x", f"[{BLANKS}]", " ")),
        (NOTHING, _strip("x", f"[{NOTHING}]")),
        (r"\x{200C}\x{200D}", _joiners("x")),
        (r"\x{FE00}-\x{FE0F}\x{E0020}-\x{E007F}\x{E0100}-\x{E01EF}\x{180B}-\x{180D}\x{180F}", _selectors("x")),
        (DIRECTIONAL, f"CASE WHEN regexp_matches(x, '[{right_to_left}{TURNING}]') THEN x ELSE {_strip('x', f'[{DIRECTIONAL}]')} END"),
        (char_class(map(ord, forms)), _replaced("x", forms)),
        # Composed first, so that an accented letter has one form before it is mapped, and again after it.
        (r"\x{80}-\x{10FFFF}", "nfc_normalize(x)"),
        (char_class(map(ord, letters)), f"nfc_normalize({_replaced('x', letters)})"),
    ]


def canonical_query(source: str, text: str) -> str:
    """SELECT of all columns of source and the canonical form of its column text, as `canonical`."""
    q = f"SELECT *, {text} AS x FROM {source}"
    for chars, sql in steps():
        q = f"SELECT * REPLACE (CASE WHEN regexp_matches(x, '[{chars}]') THEN {sql} ELSE x END AS x) FROM ({q})"
    return f"SELECT * RENAME (x AS canonical) FROM ({q})"


#: A form that is nothing but blanks and line breaks is empty.
_EMPTY = "trim(canonical, ' ' || chr(10) || chr(11) || chr(12)) = ''"


def canonical_texts(df: DataFrame, key: str, text: str, hashed: bool = False) -> DataFrame:
    """(key, canonical) of every row; a null text stays null. With hashed (key, form, raw): md5 of the
    canonical form and of the text, both null where the canonical form is nothing but blanks and line
    breaks. Nothing is shuffled; whole texts; other columns are never read."""
    canonical = canonical_query("rows", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
        for b in batches:
            rows = pa.Table.from_batches([b.rename_columns(["k", "t"])])
            con.register("rows", rows)
            if hashed:
                q = f"SELECT k, CASE WHEN NOT {_EMPTY} THEN unhex(md5(canonical)) END AS form, CASE WHEN NOT {_EMPTY} THEN unhex(md5(t)) END AS raw FROM ({canonical})"
            else:
                q = f"SELECT k, canonical FROM ({canonical})"
            got = con.sql(q).to_arrow_table()
            con.unregister("rows")
            names = [key, *got.column_names[1:]]
            kinds = [b.schema.field(0).type, *[pa.binary() if hashed else pa.string()] * (len(names) - 1)]
            yield from got.rename_columns(names).cast(pa.schema(list(zip(names, kinds, strict=True)))).to_batches()

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, form binary, raw binary" if hashed else f"`{key}` {kind}, canonical string")


def look_classes(forms: DataFrame, key: str) -> DataFrame:
    """(form, class_id, n_documents, n_texts) of each form: its smallest key, documents, different texts.
    Different texts are counted first, on the map side, so a form with a third of all rows is folded
    where its rows are."""
    texts = forms.where("form is not null").groupBy("form", "raw").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
    return texts.groupBy("form").agg(F.min("first").alias("class_id"), F.sum("n").alias("n_documents"), F.count(F.lit(1)).alias("n_texts"))


def document_classes(forms: DataFrame, key: str) -> DataFrame:
    """(key, class_id): every document with the smallest key of those that look like it. A null, empty or
    all-blank text is in no class (null). forms is read twice: hand it over materialized."""
    classes = materialize(look_classes(forms, key).select("form", "class_id"), "look-classes")
    return lookup_join(forms.select(key, "form"), classes, ["form"], salt_on=[key], how="left").select(key, "class_id")


def lookalike_pairs(forms: DataFrame, key: str) -> DataFrame:
    """(<key>_a, <key>_b), a < b: documents whose texts differ and look the same. Exact copies of a text
    make no pair with each other. Only documents of forms with several texts are joined. A form is cut
    into as many salts as it has thousands of documents, so that a task pairs a thousand of them with the
    others, however large the class. forms is read several times: hand it over materialized."""
    salts = F.ceil(F.col("n_documents") / PAIRED_AT_ONCE).cast("int")
    several = materialize(look_classes(forms, key).where("n_texts > 1").select("form", salts.alias("_salts")), "look-classes")
    members = lookup_join(forms.where("form is not null"), several, ["form"], salt_on=[key])
    a = members.select(F.col(key).alias(f"{key}_a"), F.col("form"), F.col("raw").alias("_ra"), F.pmod(F.xxhash64(key), F.col("_salts")).cast("int").alias("_salt"))
    b = members.select(F.col(key).alias(f"{key}_b"), F.col("form"), F.col("raw").alias("_rb"), F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
    return a.join(b, ["form", "_salt"]).where((F.col(f"{key}_a") < F.col(f"{key}_b")) & (F.col("_ra") != F.col("_rb"))).select(f"{key}_a", f"{key}_b")
