"""Replace personal data and secrets by surrogates that keep type, script, gender and format.

Entities are found by pattern: e-mail addresses, international phone numbers of 7 to 15 digits,
payment card numbers (four fours, or 13 to 19 digits whose check digit holds), IPv4 addresses, keys and tokens, passwords and secrets after their label (with a
digit, so that prose is left alone), social security numbers and names after a title, with
further mentions of the same name in the text. A surrogate comes from a keyed hash (HMAC) of the entity's type and normal form: digits stay
digits, letters stay letters of their script and case, separators stay; a card keeps whether
its check digit holds, an address stays an address, a name keeps its gender by its title and
its script. The same entity gets the same surrogate in every document (coreference).

Distinct entities must stay distinct. Spark collects the distinct entities of the corpus (one
row each, combined map-side), proposes a surrogate for each, and counts proposals: where
several entities of a type propose the same one, or one proposes an entity that occurs in the
corpus, all but the first propose again with the next attempt, until none collide.

Defined results: a null text stays null and an empty one empty, with no entities; texts are
read whole; overlapping finds keep the leftmost, then the longest; rows alike in all columns
are treated alike; an empty table gives an empty result; further columns pass through, but for
one named ``entities``, which the result's own replaces.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import carried, saved, table

KEY = b"set a secret of your own"
ROUNDS = 64
#: Kinds of which only the digits count.
DIGITS = ("card", "ssn", "phone")

# The patterns of the entities, in the order in which they are preferred.
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]++@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "key": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?:(?:sk|pk|ghp|gho|xox[bp])[-_]|AKIA)(?=[_-]*[0-9A-Za-z])[0-9A-Za-z_-]{16,})(?![0-9A-Za-z])",
    "secret": r"\b(?i:pass(?:word|wd|phrase)|pwd|secret|token|api[_-]?key)\s{0,3}[:=]\s{0,3}[\"']?(?P<said>(?=[^\s\"'<>&,;]{0,200}\d)[^\s\"'<>&,;]{3,}[^\s\"'<>&,;.:!?)])",
    "card": r"(?<![\d.])\d{4}(?:[ -]?\d{4}){3}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+\d(?:(?:[   .]|[ ]?[-/‑–][ ]?|[ ]?\([ ]?|[ ]?\)[ ]?)?\d){6,14}(?!\d)",
    "man": r"(?<=\bMr\.[ ])\p|(?<=\bMr[ ])\p|(?<=\bHerr[ ])\p|(?<=\bHerrn[ ])\p|(?<=\bSr\.[ ])\p|(?<=\bSeñor[ ])\p|(?<=\bMonsieur[ ])\p|(?<=\bг-н[ ])\p",
    "woman": r"(?<=\bMrs\.[ ])\p|(?<=\bMs\.[ ])\p|(?<=\bMiss[ ])\p|(?<=\bMrs[ ])\p|(?<=\bFrau[ ])\p|(?<=\bSra\.[ ])\p|(?<=\bSeñora[ ])\p|(?<=\bMadame[ ])\p|(?<=\bг-жа[ ])\p",
    "number": r"(?<![\d.])\d(?:[ -]?\d){12,18}(?!\d)",  # a card if it passes for one
}
# O'Brien, McDonald, Smith; with initials, and up to three of them
UPPER, LOWER = "A-ZÀ-ÖØ-ÞЁА-Я", "a-zà-öø-ÿёа-я"
NAME = rf"[{UPPER}](?:['’][{UPPER}])?[{LOWER}]+(?:[{UPPER}][{LOWER}]+)*"
PERSON = rf"(?-i:(?:[{UPPER}]\.[ ]?){{0,3}}{NAME}(?:[ -](?:[{UPPER}]\.[ ]?){{0,3}}{NAME}){{0,2}})"
# Given names and family names by gender and script, ASCII first.
GIVEN = {
    ("man", "latin"): "Adam Boris Carl David Emil Frank Georg Hugo Ivan Jonas Karl Louis Marco Nils Oscar Paul Robert Simon Thomas Victor".split(),
    ("woman", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera".split(),
    ("man", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Николай Олег Павел Роман".split(),
    ("woman", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лидия Мария Нина Ольга Полина София".split(),
}
FAMILY = {
    ("man", "latin"): "Abel Berger Costa Duval Engel Fischer Garcia Hansen Ibsen Jansen Keller Lambert Moreau Navarro Olsen Perez Quist Romero Schmidt Torres".split(),
    ("man", "cyrillic"): "Антонов Белов Власов Громов Данилов Ершов Жуков Зуев Исаев Козлов Лапин Морозов Носов Орлов".split(),
}
FAMILY["woman", "latin"] = FAMILY["man", "latin"]
FAMILY["woman", "cyrillic"] = [name + "а" for name in FAMILY["man", "cyrillic"]]

ALONE = re.compile(PATTERNS["key"])
FINDER = re.compile("|".join(f"(?P<{kind}>{pattern.replace(chr(92) + 'p', PERSON)})" for kind, pattern in PATTERNS.items()))
#: A text without any of these has no entity: most texts are passed over by this plain search.
HINT = re.compile(r"[@0-9+]|\b(?:M(?:rs?|s|iss|adame|onsieur)|Herrn?|Frau|Sra?|Señora?)\b|г-|(?:sk|pk|ghp|gho|xox[bp])[-_]|AKIA|[a-f]{32}|[A-F]{32}")

carried(__name__)


def find(text: str | None) -> list[tuple[int, int, str]]:
    """Entities of a text as (start, end, kind), leftmost first."""
    if not text or not HINT.search(text):
        return []
    found, at = [], 0
    while m := FINDER.search(text, at):
        kind, at = m.lastgroup, m.end()
        if m["said"] is not None:
            found.append((m.start("said"), at, _labelled(m["said"])))
        elif kind != "number":
            found.append((m.start(), at, kind))
        elif is_card(m[0]):
            found.append((m.start(), at, "card"))
        else:
            at = m.start() + 1
    return _again(text, found)


def _again(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The finds with further mentions of their names between them."""
    names: dict[str, str] = {}
    for a, b, kind in found:
        if kind in ("man", "woman"):
            names.setdefault(text[a:b], kind)
    if not names:
        return found
    known = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
    out, at = [], 0
    for a, b, kind in [*found, (len(text), len(text), "")]:
        out += [(m.start(), m.end(), names[m[0]]) for m in known.finditer(text, at, a)]
        if kind:
            out.append((a, b, kind))
        at = b
    return out


def is_card(value: str) -> bool:
    """Whether 13 to 19 digits pass for a card: by first digit, as epochs are no cards, and check digit."""
    digits = re.sub(r"\D", "", value)
    return (digits[0] in "23456" or digits[0] == "1" and len(digits) == 15) and luhn(digits)


def _labelled(value: str) -> str:
    """The kind of what follows a label: a key is the same key without one."""
    return "key" if ALONE.fullmatch(value) else "secret"


def normal(kind: str, value: str) -> str:
    """What two mentions of one entity have in common: its format does not count."""
    if kind in DIGITS:
        return re.sub(r"\D", "", value)
    return value.casefold() if kind in ("email", "key") else value


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


class Stream:
    """Numbers from a keyed hash, as many as are asked for."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.seed = key, "\x1f".join(map(str, parts)).encode()
        self.turn, self.bits = 0, 0
        self.left = 1

    def below(self, n: int) -> int:
        if self.left < n << 16:
            block = hmac.new(self.key, self.seed + self.turn.to_bytes(4, "big"), hashlib.sha256).digest()
            self.bits, self.left, self.turn = int.from_bytes(block, "big"), 1 << 256, self.turn + 1
        self.bits, value = divmod(self.bits, n)
        self.left //= n
        return value


def _letter(c: str, draw: Stream) -> str:
    """A letter or digit of the same script and case; other characters stay."""
    if c.isdigit():
        return str(draw.below(10)) if c.isascii() else c
    for first, last in (("a", "z"), ("A", "Z"), ("а", "я"), ("А", "Я"), ("α", "ω"), ("Α", "Ω")):
        if first <= c <= last:
            return chr(ord(first) + draw.below(ord(last) - ord(first) + 1)).replace("΢", "Σ")
    if c.isalpha():
        return _letter("A" if c.isupper() else "a", draw) if c.isalpha() and ord(c) < 0x250 else c
    return c


def surrogate(kind: str, value: str, attempt: int, key: bytes = KEY) -> str:
    """The replacement in normal form, of the value in normal form, at an attempt."""
    draw = Stream(key, kind, value, attempt)
    # few letters leave few surrogates, and none of them leaves one: later attempts add some
    more = "".join(_letter("a", draw) for _ in range(max(0, attempt - 2))) if kind not in DIGITS else ""
    further = "".join(str(draw.below(10)) for _ in range(max(0, attempt - 8))) if kind in DIGITS else ""
    if kind == "email":
        local, _, _ = value.partition("@")
        return "".join(_letter(c, draw) for c in local) + (
            "" if len(local) > 6 else "".join(_letter("a", draw) for _ in range(7 - len(local)))) + more + "@example.com"
    if kind == "ip":
        # private, then reserved, then all addresses
        first = 10 if attempt < 8 else 240 + draw.below(15) if attempt < 24 else 1 + draw.below(254)
        return f"{first}.{draw.below(256)}.{draw.below(256)}.{1 + draw.below(254)}"
    if kind in ("key", "secret"):
        kept = 2 if kind == "key" else 0
        if set(value) <= set("0123456789abcdef"):
            return "".join("0123456789abcdef"[draw.below(16)] for _ in value) + more
        return value[:kept] + "".join(_letter(c, draw) for c in value[kept:]) + more
    if kind == "card":
        body = "".join(str(draw.below(10)) for _ in value[:-1]) + further
        check = next(c for c in "0123456789" if luhn(body + c))
        return body + (check if luhn(value) else str((int(check) + 1 + draw.below(9)) % 10))
    if kind == "ssn":
        return "9" + "".join(str(draw.below(10)) for _ in value[1:]) + further
    if kind == "phone":
        return value[:1] + "".join(str(draw.below(10)) for _ in value[1:]) + further
    script = "cyrillic" if "Ѐ" <= value[0] <= "ӿ" else "latin"
    given, family = GIVEN[kind, script], FAMILY[kind, script]
    parts = [family[draw.below(len(family))] for _ in re.findall(r"[ -]", value)]
    names = [given[draw.below(len(given))]] if parts or attempt % 2 else [family[draw.below(len(family))]]
    for part in range(max(0, attempt - 2)):  # the lists are used up: more family names
        parts.append(family[draw.below(len(family))])
    return " ".join(names + parts)


def fitted(kind: str, mention: str, replacement: str) -> str:
    """The surrogate in the format of a mention: its separators and its case."""
    if kind in DIGITS:
        digits = iter(replacement)
        # a surrogate that had to grow has digits left over
        return "".join([*[next(digits) if c.isdigit() else c for c in mention], *digits])
    if kind == "key" and mention.upper() == mention:
        return replacement.upper()
    return replacement


FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.string())]))
FOUND_DDL = "array<struct<start: bigint, end: bigint, kind: string, value: string>>"


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("doc").field("text").to_pylist()
        found = [[{"start": a, "end": b, "kind": kind, "value": normal(kind, text[a:b])} for a, b, kind in find(text)]
                 for text in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, FOUND)], names=["doc", "found"])


def _propose(key: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(surrogate=[surrogate(k, v, n, key) for k, v, n in zip(
                batch["kind"], batch["value"], batch["attempt"])])

    return run


def surrogate_table(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """One row (kind, value, surrogate) per distinct (kind, value); surrogates of a kind are distinct."""
    entities = entities.select("kind", "value").distinct()
    schema = "kind string, value string, attempt int, surrogate string"
    state = saved(entities.withColumn("attempt", F.lit(0)).mapInPandas(_propose(key), schema), "surrogates")
    for _ in range(ROUNDS):
        first = state.groupBy("kind", "surrogate").agg(
            F.min("value").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        real = state.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        clash = saved(
            state.join(first, ["kind", "surrogate"], "left").join(real, ["kind", "surrogate"], "left")
            .where("real or value != first").select("kind", "value"), "clash")
        if clash.isEmpty():
            return state.select("kind", "value", "surrogate")
        again = state.join(clash, ["kind", "value"], "left_semi").select(
            "kind", "value", (F.col("attempt") + 1).alias("attempt")).mapInPandas(_propose(key), schema)
        state = saved(state.join(clash, ["kind", "value"], "left_anti").select(
            "kind", "value", "attempt", "surrogate").union(again), "surrogates")
    raise ValueError(f"entities still collide after {ROUNDS} rounds: a kind has too few surrogates")


def _replaced(text: str, found: list[dict], known: dict[tuple[str, str], str]) -> tuple[str, list[dict]]:
    out, at, entities, place = [], 0, [], 0
    for m in found:
        new = fitted(m["kind"], text[m["start"]:m["end"]], known[m["kind"], m["value"]])
        out += [text[at:m["start"]], new]
        place += m["start"] - at
        entities.append({"kind": m["kind"], "start": place, "end": place + len(new)})
        place, at = place + len(new), m["end"]
    return "".join([*out, text[at:]]), entities


ENTITIES = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
ENTITIES_DDL = "array<struct<kind: string, start: bigint, end: bigint>>"


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, texts, spans = batch.column("doc"), [], []
        for text, found, pairs in zip(doc.field("text").to_pylist(), batch.column("found").to_pylist(),
                                      batch.column("known").to_pylist()):
            new, entities = _replaced(text, found, {(p["kind"], p["value"]): p["surrogate"] for p in pairs})
            texts.append(new)
            spans.append(entities)
        columns = doc.flatten()
        columns[doc.type.get_field_index("text")] = pa.array(texts, pa.string())
        docs = pa.StructArray.from_arrays(columns, fields=list(doc.type))
        yield pa.RecordBatch.from_arrays([docs, pa.array(spans, ENTITIES)], names=["doc", "entities"])


def pseudonymised(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``entities`` (kind, start, end) in the new text.

    Texts are searched once, and what is found is saved with them. Only texts with entities
    meet their surrogates in a join; the others pass as they are.
    """
    docs = docs.drop("entities")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    doc = T.StructField("doc", packed.schema["doc"].dataType, False)
    found = saved(packed.mapInArrow(_mentions, T.StructType([doc]).add("found", T.DataType.fromDDL(FOUND_DDL))), "found", "zstd")
    surrogates = surrogate_table(found.select(F.explode("found").alias("m")).select("m.*"), key)
    some = found.where(F.size("found") > 0).withColumn("row", F.xxhash64("doc.text"))
    # the surrogates that a text needs, gathered per text: as many as the text has entities
    known = some.select("row", F.explode("found").alias("m")).select("row", "m.kind", "m.value").distinct().join(
        surrogates, ["kind", "value"]).groupBy("row").agg(
        F.collect_list(F.struct("kind", "value", "surrogate")).alias("known"))
    changed = some.join(known, "row").select("doc", "found", "known").mapInArrow(
        _replace, T.StructType([doc]).add("entities", T.DataType.fromDDL(ENTITIES_DDL)))
    others = found.where(F.size("found") == 0).select("doc", F.array().cast(ENTITIES_DDL).alias("entities"))
    return changed.union(others).select("doc.*", "entities")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", F.size("entities").cast("long").alias("n_entities"),
        F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"])).alias("entities"))
