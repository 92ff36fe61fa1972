"""Benchmark decontamination by canonical templates.

Numbers, quantities with a unit, and names become typed placeholders; other words lose their case and the punctuation
around them. A name is a run of capitalised words that does not begin a sentence or line. Windows of ``size`` template
tokens are hashed on both sides and hash-joined, so a question that was given other numbers or names is still found.

A hit is judged by document, benchmark item and stretch of the document: offsets between the two whose windows lie in
one stretch count together, so that added or dropped words do no harm. Their windows have to cover at least ``cover`` of
the item's, and the slots have to be consistent over all of them, which is that each value of the item always stands for
the same value in the document; offsets that contradict others, or the order of words, do not count with them. Items of fewer than ``size``
tokens are one window of their own length. Where there are fewer than ``least`` tokens, the item is searched for by its
exact words, all of them, however few: a template of so few tokens says too little. An item's first word is a name or not by what stands before it in the document, so items have a second template in
which it does not begin a sentence.

Documents are read once. A bitmap of fixed size with the windows of all items is broadcast to leave out windows that no
item has; it only spares the join rows, so a crowded bitmap costs time and never results. No text is shuffled.

Defined cases: null and empty texts have no windows and are clean; a null item_id is kept as null; items with equal id
and text are one; repeated documents are judged alike; other columns are ignored by ``hits`` and kept by ``keep_clean``.
An empty table on either side gives no hits.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.llm.words import Texts, hash_spans, mix, ngrams, texts
from activitymill.llm.work import kept, unused

# Units of measure.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec secs min mins h hr hrs ms hz khz mhz ghz w kw kwh v a "
    "j kj cal kcal pa kpa bar c f k kb mb gb tb inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres gram grams kilogram kilograms pound pounds ounce ounces liter liters "
    "litre litres second seconds minute minutes hour hours day days week weeks month months year years percent degrees "
    "dollar dollars euro euros cent cents usd eur gbp mph kph"
).split()

BITMAP_BITS = 1 << 24
_NUMBER, _QUANTITY, _NAME = (mix(np.array([k], np.uint64))[0] for k in (101, 102, 103))
_EXACT = mix(np.array([104], np.uint64))[0]

# Classes of bytes, as bits: digit, letter (all of UTF-8's further bytes count as such), lower-case letter of ASCII, and
# the end of a sentence or line.
_DIGIT, _LETTER, _SMALL, _STOP = 1, 2, 4, 8
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[ord("A"):ord("Z") + 1] = _LETTER
_CLASS[ord("a"):ord("z") + 1] = _LETTER | _SMALL
_CLASS[128:] = _LETTER
_CLASS[[ord(c) for c in ".!?\n"]] = _STOP


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
    return np.sort(hash_spans(data, ends - [len(u) for u in UNITS], ends))


_UNITS = _unit_hashes()


@dataclass(frozen=True)
class Template:
    tokens: np.ndarray  # hash of a word or of a placeholder
    slots: np.ndarray  # hash of what a placeholder stands for, else 0
    offsets: np.ndarray  # of each document's tokens
    words: np.ndarray  # hash of each word that is not only punctuation
    word_offsets: np.ndarray


def _lower(piece: Texts, ascii_lower: np.ndarray) -> np.ndarray:
    """Bytes in lower case, of all scripts. Texts that would change their length have A-Z changed only."""
    column = pa.LargeStringArray.from_buffers(len(piece), pa.py_buffer(piece.offsets), pa.py_buffer(piece.data))
    lowered = pc.utf8_lower(column)
    offsets = np.frombuffer(lowered.buffers()[1], np.int64)[:len(piece) + 1]
    body = lowered.buffers()[2]
    data = np.frombuffer(body, np.uint8)[:offsets[-1]] if body is not None else ascii_lower
    if (offsets == piece.offsets).all():
        return data
    out = ascii_lower.copy()
    for k in np.flatnonzero(np.diff(offsets) == np.diff(piece.offsets)):
        out[piece.offsets[k]:piece.offsets[k + 1]] = data[offsets[k]:offsets[k + 1]]
    return out


def template(piece: Texts, amid: bool = False) -> Template:
    """Template of each text; ``amid`` is as if its first word stood within a sentence."""
    words = piece.words()
    raw, low = piece.data, _lower(piece, words.data)
    kind = _CLASS[raw]
    owner, first, last = words.documents(), words.starts.copy(), words.ends.copy()
    # Without the punctuation around them; words of nothing else go.
    for edge, step, at in ((first, 1, 0), (last, -1, -1)):
        loose = np.arange(len(first))
        while len(loose):
            loose = loose[first[loose] < last[loose]]
            loose = loose[kind[edge[loose] + at] & (_DIGIT | _LETTER) == 0]
            edge[loose] += step
    some = first < last
    owner, first, last = owner[some], first[some], last[some]
    if not len(first):
        none = np.zeros(0, np.uint64)
        empty = np.zeros(len(piece) + 1, np.int64)
        return Template(none, none, empty, none, empty)
    value = hash_spans(low, first, last)
    # What each word holds, and what stands between it and the next.
    edges = np.empty(2 * len(first), np.int64)
    edges[::2], edges[1::2] = first, last
    held = np.bitwise_or.reduceat(np.append(kind, np.uint8(0)), edges)
    inside, between = held[::2], held[1::2]
    between[last == np.append(first[1:], -1)] = 0

    has_digit, has_letter = inside & _DIGIT > 0, inside & _LETTER > 0
    number = has_digit & ~has_letter
    # 5km: digits, then a unit.
    quantity = has_digit & has_letter & (kind[first] == _DIGIT)
    mixed = np.flatnonzero(quantity)
    tail = first[mixed].copy()
    ahead = np.arange(len(mixed))
    while len(ahead):
        ahead = ahead[kind[tail[ahead]] & _LETTER == 0]
        tail[ahead] += 1
    quantity[mixed] = np.isin(hash_spans(low, tail, last[mixed]), _UNITS)
    # 5 km: a number, then a unit on its own.
    same = np.zeros(len(first), bool)
    same[1:] = owner[1:] == owner[:-1]
    unit = np.zeros(len(first), bool)
    unit[1:] = same[1:] & number[:-1] & ~has_digit[1:]
    unit[unit] = np.isin(value[unit], _UNITS)
    before_unit = np.zeros(len(first), bool)
    before_unit[:-1] = unit[1:]

    begins = np.ones(len(first), bool)
    begins[1:] = ~same[1:] | (between[:-1] & _STOP > 0)
    if amid:
        begins &= same
    second = np.minimum(first + 1, last - 1)
    capital = (raw[first] != low[first]) | ((raw[first] >= 128) & (raw[second] != low[second]))
    name = capital & (inside & _SMALL > 0) & ~begins & ~has_digit
    name_goes_on = np.zeros(len(first), bool)
    name_goes_on[1:] = name[1:] & name[:-1] & same[1:]

    tokens = value.copy()
    tokens[number] = _NUMBER
    tokens[quantity | before_unit] = _QUANTITY
    tokens[name] = _NAME
    slots = np.where(number | quantity | name, value | np.uint64(1), np.uint64(0))
    slots[before_unit] = mix(slots[before_unit] + value[np.flatnonzero(before_unit) + 1]) | np.uint64(1)
    head = ~(unit | name_goes_on)
    if name_goes_on.any():  # a name's value is that of all its words
        group = np.cumsum(head) - 1
        whole = np.zeros(int(head.sum()), np.uint64)
        np.add.at(whole, group[name], mix(value[name] + np.arange(len(name), dtype=np.uint64)[name]
                                           - np.flatnonzero(head)[group[name]].astype(np.uint64)))
        slots[head & name] = whole[group[head & name]] | np.uint64(1)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[head], minlength=len(piece)))])
    word_offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(piece)))])
    return Template(tokens[head], slots[head], offsets, value, word_offsets)


def by_words(t: Template) -> Template:
    """The words themselves in place of a template."""
    return Template(t.words ^ _EXACT, np.zeros(len(t.words), np.uint64), t.word_offsets, t.words, t.word_offsets)


def windows(t: Template, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first token of each window that lies in one document."""
    found = ngrams(t.tokens, size) ^ mix(np.array([size], np.uint64))[0]
    owner = np.repeat(np.arange(len(t.offsets) - 1), np.diff(t.offsets))
    whole = owner[:len(found)] == owner[size - 1:] if len(found) else np.zeros(0, bool)
    return found[whole], np.flatnonzero(whole)


def _slot_lists(t: Template, at: np.ndarray, size: int) -> pa.Array:
    values = t.slots[at[:, None] + np.arange(size)].view(np.int64).ravel()
    return pa.ListArray.from_arrays(np.arange(0, len(values) + 1, size, dtype=np.int32), pa.array(values))


_ITEM = (
    "item_id long, item long, variant int, size int, place long, window long, slots array<long>, windows long, "
    "needed double"
)
_PLAIN, _AMID, _WORDS = 0, 1, 2  # variants of an item


def item_windows(benchmark: DataFrame, size: int, least: int, cover: float) -> DataFrame:
    """Windows of all items, each with its place, slots, the number of windows that its item has and how many of them
    make a hit. The size of windows of exact words is negative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in texts(batch.column("text")):
                plain, amid = template(piece), template(piece, amid=True)
                exact = by_words(plain)
                of_words, of_plain, of_amid = (np.diff(t.offsets) for t in (exact, plain, amid))
                cut = np.minimum(of_plain, of_amid) < least
                other = np.array([
                    not np.array_equal(plain.tokens[i:j], amid.tokens[k:m]) for i, j, k, m in
                    zip(plain.offsets, plain.offsets[1:], amid.offsets, amid.offsets[1:])
                ], bool)
                ways = [(_WORDS, exact, least, np.where(cut & (of_words >= least), of_words, 0), 1.0)]
                for n in range(1, least):
                    ways.append((_WORDS, exact, n, np.where(of_words == n, of_words, 0), 1.0))
                for n in range(least, size + 1):
                    for variant, t, counts in ((_PLAIN, plain, of_plain), (_AMID, amid, np.where(other, of_amid, 0))):
                        own = np.where((counts == n) if n < size else (counts >= size), counts, 0)
                        ways.append((variant, t, n, own, cover))
                for variant, t, n, counts, share in ways:
                    found, at = windows(t, n)
                    owner = np.searchsorted(t.offsets, at, "right") - 1
                    own = counts[owner] > 0
                    found, at, owner = found[own], at[own], owner[own]
                    if len(found):
                        take, number = pa.array(piece.first + owner), counts[owner] - n + 1
                        yield pa.RecordBatch.from_arrays([
                            batch.column("item_id").take(take), batch.column("item").take(take),
                            pa.array(np.full(len(found), variant, np.int32)),
                            pa.array(np.full(len(found), -n if variant == _WORDS else n, np.int32)),
                            pa.array(at - t.offsets[owner]), pa.array(found.view(np.int64)), _slot_lists(t, at, n),
                            pa.array(number), pa.array(number * share),
                        ], ["item_id", "item", "variant", "size", "place", "window", "slots", "windows", "needed"])

    named = benchmark.select("item_id", "text", F.xxhash64("item_id", F.coalesce("text", F.lit(""))).alias("item"))
    return named.mapInArrow(run, _ITEM).dropDuplicates(["item", "variant", "size", "place"])


def _bitmap(items: DataFrame) -> np.ndarray:
    bit = F.pmod("window", F.lit(BITMAP_BITS)) + 1  # the functions below count from 1
    rows = items.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    ).collect()  # at most BITMAP_BITS / 32768 rows of 4 KB
    out = np.zeros(BITMAP_BITS // 8 + 8192, np.uint8)
    for r in rows:
        # A part holds the bits from 32768 (part - 1) on.
        out[(r.part - 1) * 4096:r.part * 4096] |= np.frombuffer(r.bits, np.uint8)
    return out


def _document_windows(docs: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """Windows of documents that some item may have: rid, doc_id, place, window and slots."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for piece in texts(batch.column("text")):
                t = template(piece)
                whole = t
                for size in sizes:
                    t, n = (by_words(whole), -size) if size < 0 else (whole, size)
                    found, at = windows(t, n)
                    bit = np.mod(found.view(np.int64), BITMAP_BITS)
                    maybe = (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
                    found, at = found[maybe], at[maybe]
                    if len(found):
                        owner = np.searchsorted(t.offsets, at, "right") - 1
                        take = pa.array(piece.first + owner)
                        yield pa.RecordBatch.from_arrays([
                            batch.column("rid").take(take), batch.column("doc_id").take(take),
                            pa.array(at - t.offsets[owner]), pa.array(found.view(np.int64)), _slot_lists(t, at, n),
                        ], ["rid", "doc_id", "at", "window", "values"])

    return docs.mapInArrow(run, "rid long, doc_id long, at long, window long, values array<long>")


def _row_id() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def agreeing(met: list[dict], needed: float, apart: bool = True) -> tuple[int, int] | None:
    """Places and different slot values of windows that are ``needed`` places at least and agree in their slots; if
    they may not be ``apart``, of one offset."""
    offsets: dict[int, dict[int, dict[int, int]]] = {}  # by place, what values stand for
    values: dict[int, dict[int, int]] = {}
    unfit = set()
    for m in met:
        shift = m["at"] - m["place"]
        own = {given: value for given, value in zip(m["slots"], m["values"]) if given}
        offsets.setdefault(shift, {})[m["place"]] = own
        whole = values.setdefault(shift, {})
        if any(given and whole.setdefault(given, value) != value for given, value in zip(m["slots"], m["values"])):
            unfit.add(shift)
    order = sorted(offsets.keys() - unfit, key=lambda shift: (-len(offsets[shift]), shift))
    if len(set().union(*(offsets[shift] for shift in order))) < needed:
        return None
    for first in order:
        chosen, taken = {place: place + first for place in offsets[first]}, dict(values[first])
        for shift in order if apart else ():
            # The order of the places is that of the document, so that no word of it stands for two.
            ascending = sorted(chosen)
            new = {}
            for place in offsets[shift]:
                k = bisect.bisect(ascending, place)
                before = chosen[ascending[k - 1]] if k else -1
                after = chosen[ascending[k]] if k < len(ascending) else place + shift + 1
                if place not in chosen and before < place + shift < after:
                    new[place] = place + shift
            own = {given: value for place in new for given, value in offsets[shift][place].items()}
            if all(taken.get(given, value) == value for given, value in own.items()):
                chosen.update(new)
                taken.update(own)
        if len(chosen) >= needed:
            return len(chosen), len(taken)
    return None


def _judged(together: DataFrame) -> DataFrame:
    """Of items and the windows they have in a stretch of a document, those that are held there."""
    names = ["rid", "doc_id", "item", "item_id", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, len(batch), 256)):
                asked = zip(part.column("met"), part.column("needed").to_pylist(), part.column("variant").to_pylist())
                found = [agreeing(met.as_py(), needed, variant != _WORDS) for met, needed, variant in asked]
                own = part.select(names).filter(pa.array([x is not None for x in found], pa.bool_()))
                matched, slots = ([x[k] for x in found if x is not None] for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(matched, pa.int64()), pa.array(slots, pa.int64())],
                    [*names, "matched", "slots"])

    return together.mapInArrow(
        run, "rid long, doc_id long, item long, item_id long, windows long, matched long, slots long")


def hits(
    docs: DataFrame, benchmark: DataFrame, *, size: int = 8, least: int = 5, cover: float = 0.5
) -> DataFrame:
    """Documents that hold an item: doc_id, item_id, matched and all windows of the item, their share, and the number
    of different slot values. ``rid`` names the document's row."""
    items = item_windows(benchmark, size, least, cover)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most size + 1 rows
    rows = docs.select("doc_id", "text", _row_id().alias("rid"))
    found = _document_windows(rows, _bitmap(items), sizes).dropDuplicates(["rid", "at", "window"])
    met = found.join(items, "window")
    # Stretches of some four times an item's length, each half over the next: what lies within half of one is whole in
    # one of them, and a row is bounded however long the document.
    half = 2 * (F.col("windows") + size)
    cell = F.floor(F.col("at") / half)
    placed = met.withColumn("cell", F.explode(F.array(cell, cell - 1)))
    hit = ["rid", "doc_id", "item", "item_id", "windows"]
    together = placed.groupBy(*hit, "variant", "needed", "cell").agg(
        F.collect_list(F.struct("place", "at", "slots", "values")).alias("met")
    )
    enough = together.filter(F.size(F.array_distinct("met.place")) >= F.col("needed"))
    judged = _judged(enough.select(*hit, "variant", "needed", "met"))
    # Of an item's variants the one with the larger share is told.
    share = F.col("matched") / F.col("windows")
    best = judged.groupBy("rid", "doc_id", "item", "item_id").agg(
        F.max(F.struct(share.alias("share"), "matched", "windows", "slots")).alias("best")
    )
    return best.select(
        "doc_id", "item_id", "best.matched", "best.windows", "best.share", "best.slots", "rid"
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    rid = unused(docs, "_rid")
    # Written first, so that Spark knows how few there are and leaves the documents where they are.
    held = kept(hits(docs, benchmark, **options).select(F.col("rid").alias(rid)).distinct(), "held")
    return docs.withColumn(rid, _row_id()).join(held, rid, "left_anti").drop(rid)
