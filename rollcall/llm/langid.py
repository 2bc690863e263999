"""Language identification by interpolated Kneser-Ney character models.

Symbols are code points: letters and the marks that belong to them, in lower case, and one
symbol for everything between words. A model counts triples of symbols; three code
points of 21 bits are one sorted 63-bit key. The counts cover the whole corpus and are
summed in Spark. Up to MODEL_GRAMS triples over all languages are given to every task as
sorted arrays; the models of more triples stay tables in Spark, tasks know the most
frequent ones, and the rest of each text is joined with the tables.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.scratch import materialize

_BITS = 21
_ONE, _TWO = (1 << _BITS) - 1, (1 << 2 * _BITS) - 1
#: Numbers of triples, over all languages, that a task holds at most. What goes beyond is
#: joined, so this decides where a triple is looked up, never what is found.
MODEL_GRAMS = 1 << 22
#: Code points handled at a time. A longer text is read in windows that know the two
#: symbols before them.
WINDOW = 1 << 20
#: Lengths in symbols for which limits are learned; a text goes by the largest that it has.
CLASSES = (8, 32, 128, 512, 2048)
#: A limit: the median of training texts of a length, and so many times the distance from
#: there to their 95th percentile, or at least so many nats a symbol: real texts hold
#: names, lists and passages of other languages.
SPREAD, LEAST_SLACK = 4.0, 1.0
UNKNOWN = "und"
_LETTER = regex.compile(r"(?<!\p{M})\p{L}")


@lru_cache(maxsize=1)
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of every code point: the lower case of letters, marks as they are, 0 for
    others; and whether it is a mark."""
    table, marks = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind in "LM":
            table[point] = ord(chr(point).lower()[0])
        marks[point] = kind == "M"
    return table, marks


def _symbols(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of code points, and which are marks: a mark that belongs to no letter (such
    as follows a pictograph) is none."""
    table, marks = alphabet()
    symbol, mark = table[codes], marks[codes]
    if mark.any():
        base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(codes))))
        symbol = np.where(mark & (symbol[base] == 0), 0, symbol)
    return symbol, mark


class Symbols:
    """The symbols of some texts, end to end: `gram` has the last three symbols at every
    place, `text` the number of the text it belongs to. Gaps between words are one
    symbol each, and every text begins with one that is not predicted. Of texts that go
    on from an earlier window, the first two characters are known, not predicted."""

    def __init__(self, texts: list[str], goes_on: list[bool] | None = None):
        joined = "\n" + "\n".join(texts)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
        symbol, mark = _symbols(codes)
        begins = np.zeros(len(codes), bool)
        at = np.cumsum(lengths) - lengths
        begins[at] = True
        known = begins.copy()
        if goes_on is not None:
            for more in (1, 2):
                known[at[np.array(goes_on, bool)] + more] = True
        keep = symbol != 0
        keep[1:] |= symbol[:-1] != 0
        keep |= begins
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        self.letters = np.bincount(owner, (symbol != 0) & ~mark & ~known, len(texts)).astype(np.int64)
        symbol, owner, begins, known = symbol[keep].astype(np.int64), owner[keep], begins[keep], known[keep]
        one = np.concatenate([[0], symbol[:-1]])
        two = np.concatenate([[0, 0], symbol[:-2]])[: len(symbol)]
        two[1:][begins[:-1]] = 0  # right after its first gap, a text knows nothing earlier
        # A gap that follows a text's first one is that gap.
        again = np.zeros(len(symbol), bool)
        again[1:] = begins[:-1] & (symbol[1:] == 0) & ~begins[1:]
        told = ~known & ~again
        self.gram = (two << 2 * _BITS | one << _BITS | symbol)[told]
        self.text = owner[told]


def windows(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str], list[bool]]]:
    """(rows, parts of texts, whether a part goes on) of at most about WINDOW code points
    together. A part that goes on begins with the two characters before it, the second
    of which is a letter and the first no mark, so that they say what the two symbols
    before it are."""
    rows, parts, goes_on, held = [], [], [], 0
    for row, text in enumerate(texts):
        at, size = 0, len(text or "")
        while at < size:
            end = size
            if size - at > WINDOW:
                letter = _LETTER.search(text, at + WINDOW - 1)
                end = letter.end() if letter else size
            part = text[max(at - 2, 0) : end]
            if parts and held + len(part) > WINDOW:
                yield np.array(rows), parts, goes_on
                rows, parts, goes_on, held = [], [], [], 0
            rows.append(row)
            parts.append(part)
            goes_on.append(at > 0)
            held, at = held + len(part), end
    if parts:
        yield np.array(rows), parts, goes_on


def _distinct(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct triples, ascending, and the place of each among them: without sorting
    as long as few symbols occur."""
    shifts = (2 * _BITS, _BITS, 0)
    seen = np.zeros(0x110000, bool)
    for by in shifts:
        seen[gram >> by & _ONE] = True
    points = np.flatnonzero(seen)
    n = len(points)
    if n > 256:
        return np.unique(gram, return_inverse=True)
    local = np.zeros(0x110000, np.int32)
    local[points] = np.arange(n, dtype=np.int32)
    code = np.zeros(len(gram), np.int32)
    for by in shifts:
        code = code * n + local[gram >> by & _ONE]
    there = np.zeros(n**3, bool)
    there[code] = True
    place = np.cumsum(there, dtype=np.int32) - 1
    found = np.flatnonzero(there)
    keys = points[found // n // n] << 2 * _BITS | points[found // n % n] << _BITS | points[found % n]
    return keys, place[code]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, n)
    return found, total


def count_grams(training: DataFrame) -> DataFrame:
    """Rows (lang, gram, n) over all rows (text, lang), summed per task before the
    exchange, a few million distinct triples at a time."""

    def work(batches):
        held: dict[str, list] = {}
        n_held = 0

        def done():
            for name, parts in held.items():
                grams, n = _summed(*(np.concatenate(x) for x in zip(*parts)))
                columns = [pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            names, number = np.unique(langs, return_inverse=True)
            for rows, parts, goes_on in windows(batch.column(0).to_pylist()):
                symbols = Symbols(parts, goes_on)
                of = number[rows][symbols.text]
                for k, name in enumerate(names):
                    grams, at = _distinct(symbols.gram[of == k])
                    own = held.setdefault(name, [])
                    own.append((grams, np.bincount(at, minlength=len(grams))))
                    n_held += len(grams)
                    if len(own) > 32:
                        merged = _summed(*(np.concatenate(x) for x in zip(*own)))
                        n_held -= sum(len(g) for g, _ in own) - len(merged[0])
                        held[name] = [merged]
            if n_held > 1 << 22:
                yield from done()
                held, n_held = {}, 0
        yield from done()

    counted = training.select("text", "lang").mapInArrow(work, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """Of (lang, gram, n) the triples that occur most, at most `most` over all languages,
    as many for each: the least count that a language's share has room for is read from
    a histogram of its counts. `counts` should be a written table. This chooses what tasks
    know by themselves; `Spread` holds all triples."""
    held = counts.groupBy("lang", "n").agg(F.count("*").alias("grams"))
    upto = F.sum("grams").over(W.partitionBy("lang").orderBy(F.desc("n")))
    langs = F.lit(max(1, counts.select("lang").distinct().count()))
    least = held.withColumn("upto", upto).where(F.col("upto") * langs <= most).groupBy("lang").agg(F.min("n").alias("least"))
    return counts.join(least, "lang").where("n >= least").select("lang", "gram", "n")


def _discount(counts: np.ndarray) -> float:
    return _discount_of((counts == 1).sum(), (counts == 2).sum())


def _discount_of(once: int, twice: int) -> float:
    return float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9))


def _look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(asked), otherwise)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], otherwise)


class Smoothed:
    """One language's interpolated Kneser-Ney model in sorted arrays: probabilities of the
    triples, pairs and symbols seen, and the weights that contexts leave to shorter ones."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        order = np.argsort(gram)
        self.keys, n = gram[order].astype(np.int64), n[order].astype(float)
        context, pair = self.keys >> _BITS, self.keys & _TWO
        # How many symbols a pair, and the second symbol of pairs, are seen after.
        self.pairs, pairs = np.unique(pair, return_counts=True)
        self.singles, singles = np.unique(self.pairs & _ONE, return_counts=True)
        d1, d2, d3 = _discount(singles), _discount(pairs), _discount(n)
        rest = max(d1 * len(singles) / max(singles.sum(), 1), 1e-6) / (len(singles) + 1)
        self.p1, self.rest = np.maximum(singles - d1, 0) / max(singles.sum(), 1) + rest, rest
        first, self.firsts = self.pairs >> _BITS, np.unique(self.pairs >> _BITS)
        at = np.searchsorted(self.firsts, first)
        seen, kinds = np.bincount(at, pairs), np.bincount(at)
        self.weight1 = d2 * kinds / np.maximum(seen, 1)
        self.p2 = np.maximum(pairs - d2, 0) / seen[at] + self.weight1[at] * self._one(self.pairs & _ONE)
        self.contexts = np.unique(context)
        at = np.searchsorted(self.contexts, context)
        total, kinds = np.bincount(at, n), np.bincount(at)
        self.weight2 = d3 * kinds / np.maximum(total, 1)
        self.p3 = np.maximum(n - d3, 0) / total[at] + self.weight2[at] * self._two(pair)

    def _one(self, symbol: np.ndarray) -> np.ndarray:
        return _look_up(self.singles, self.p1, symbol, self.rest)

    def _two(self, pair: np.ndarray) -> np.ndarray:
        short = _look_up(self.firsts, self.weight1, pair >> _BITS, 1.0) * self._one(pair & _ONE)
        found = _look_up(self.pairs, self.p2, pair, -1.0)
        return np.where(found >= 0, found, short)

    def log(self, gram: np.ndarray) -> np.ndarray:
        """Logarithm of each triple's last symbol given the two before."""
        short = _look_up(self.contexts, self.weight2, gram >> _BITS, 1.0) * self._two(gram & _TWO)
        found = _look_up(self.keys, self.p3, gram, -1.0)
        return np.log(np.where(found >= 0, found, short))


class Model:
    """All languages and all their triples, where these are MODEL_GRAMS or fewer."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        by = dict(list(counts.groupby("lang")))
        self.models = [Smoothed(by[k]["gram"].to_numpy(), by[k]["n"].to_numpy()) for k in self.langs]

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy in nats per symbol by language, symbols, letters) of each text, and
        the cross-entropies of its first symbols, as many as each of CLASSES says (not a
        number where it has fewer)."""
        langs = len(self.langs)
        total, heads = np.zeros((len(texts), langs)), np.full((len(texts), len(CLASSES), langs), np.nan)
        n, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for rows, parts, goes_on in windows(texts):
            symbols = Symbols(parts, goes_on)
            np.add.at(letters, rows, symbols.letters)
            if not len(symbols.gram):
                continue
            grams, at = _distinct(symbols.gram)
            logs = np.stack([m.log(grams) for m in self.models], axis=1)
            upto = np.zeros((len(at) + 1, langs))
            np.cumsum(-logs[at], axis=0, out=upto[1:])
            begins = np.flatnonzero(np.concatenate([[True], symbols.text[1:] != symbols.text[:-1]]))
            ends = np.append(begins[1:], len(at))
            of, first = rows[symbols.text[begins]], ~np.array(goes_on, bool)[symbols.text[begins]]
            np.add.at(total, of, upto[ends] - upto[begins])
            np.add.at(n, of, ends - begins)
            for c, size in enumerate(CLASSES):
                long = first & (ends - begins >= size)
                heads[of[long], c] = (upto[begins[long] + size] - upto[begins[long]]) / size
        return total / np.maximum(n, 1)[:, None], n, letters, heads


class Shared:
    """Some triples with their logarithms in every language."""

    def __init__(self, langs: list[str], keys: np.ndarray, logs: np.ndarray):
        order = np.argsort(keys)
        self.langs, self.keys, self.values = langs, keys[order], logs[order]

    def logs(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms by language, 0 for triples that are not held; and which are not."""
        if not len(self.keys):
            return np.zeros((len(grams), len(self.langs))), np.ones(len(grams), bool)
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        lacks = self.keys[at] != grams
        return np.where(lacks[:, None], 0.0, self.values[at]), lacks

    def sums(self, symbols: Symbols, goes_on: list[bool], rows: np.ndarray, size: int):
        """Of the symbols of a window, whose texts are `rows` of a batch of `size`: the
        negative logarithms of triples held, summed by text, tier and language; symbols
        by text and tier; and (text, tier, triple, times) of triples not held. Tier 0 has a
        text's first CLASSES[0] symbols, the next ones those up to CLASSES[1], and so on;
        the last has the rest, and all of parts that go on."""
        grams, at = _distinct(symbols.gram)
        logs, lacks = self.logs(grams)
        tiers = len(CLASSES) + 1
        begins = np.flatnonzero(np.concatenate([[True], symbols.text[1:] != symbols.text[:-1]]))
        place = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
        tier = np.where(np.array(goes_on, bool)[symbols.text], tiers - 1, np.searchsorted(CLASSES, place, side="right"))
        cell = rows[symbols.text] * tiers + tier
        found = np.stack([np.bincount(cell, -logs[at, k], size * tiers) for k in range(len(self.langs))], axis=1)
        n = np.bincount(cell, minlength=size * tiers)
        absent = lacks[at]
        codes, times = np.unique(cell[absent] * len(grams) + at[absent], return_counts=True)
        cell, gram = codes // len(grams), grams[codes % len(grams)]
        return found.reshape(size, tiers, -1), n.reshape(size, tiers), (cell // tiers, cell % tiers, gram, times)


def _dense(column: pa.ListArray, langs: int, *fields: str) -> list[np.ndarray]:
    """Fields of lists of (k, ...) as arrays by row and language number k, 0 where a list
    lacks a language or is null."""
    at = np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    held = column.flatten()
    out = []
    for field in fields:
        dense = np.zeros((len(column), langs))
        dense[at, pc.struct_field(held, "k").to_numpy()] = pc.struct_field(held, field).to_numpy()
        out.append(dense)
    return out


def _vectors(values: np.ndarray) -> pa.ListArray:
    rows, size = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * size), pa.array(values.ravel()))


class Spread:
    """The same models as tables in Spark, for any number of triples: (lang, gram, n) as
    written, pairs and contexts counted from them. `shared` has the most frequent triples,
    with all languages MODEL_GRAMS numbers at most."""

    def __init__(self, counts: DataFrame):
        spark = counts.sparkSession
        self.langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
        numbers = spark.createDataFrame([(k, name) for k, name in enumerate(self.langs)], "k int, lang string")
        triples = counts.join(F.broadcast(numbers), "lang").select("k", F.col("gram").alias("key"), "n")
        by = lambda key: ("k", F.expr(key).alias("key"))
        pairs = materialize(triples.groupBy(*by(f"key & {_TWO}")).agg(F.count("*").alias("n")), "gram-pairs")
        singles = pairs.groupBy(*by(f"key & {_ONE}")).agg(F.count("*").alias("n"))
        firsts = pairs.groupBy(*by(f"shiftright(key, {_BITS})")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
        contexts = triples.groupBy(*by(f"shiftright(key, {_BITS})")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
        self.triples, self.pairs, self.singles, self.firsts, self.contexts = triples, pairs, singles, firsts, contexts

        def of_langs(table: DataFrame) -> np.ndarray:
            summed = table.groupBy("k").agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count("*"), F.sum("n"))
            return np.array([r[1:] for r in sorted(summed.collect())])

        first, second, third = of_langs(singles), of_langs(pairs), of_langs(triples)
        self.d1, self.d2, self.d3 = (np.array([_discount_of(x[0], x[1]) for x in table]) for table in (first, second, third))
        self.total = np.maximum(first[:, 3], 1)
        self.rest = np.maximum(self.d1 * first[:, 2] / self.total, 1e-6) / (first[:, 2] + 1)
        most = frequent(counts, MODEL_GRAMS // len(self.langs)).select("gram").distinct()
        held = self.logarithms(most).toArrow().combine_chunks()
        logs = held.column("logs").combine_chunks() if len(held) else None
        logs = logs.flatten().to_numpy().reshape(len(held), -1) if len(held) else np.zeros((0, len(self.langs)))
        self.shared = Shared(self.langs, held.column("gram").to_numpy().astype(np.int64), logs)

    def logarithms(self, asked: DataFrame) -> DataFrame:
        """(gram, logs) for distinct triples `gram`, learned or not: the logarithm of the
        last symbol given the two before, in each language. What pairs say is found first,
        once for each pair."""
        langs, d1, d2, d3, total, rest = len(self.langs), self.d1, self.d2, self.d3, self.total, self.rest

        def held(table: DataFrame, key: str) -> DataFrame:
            fields = [c for c in table.columns if c != "key"]
            return table.groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct(*fields)).alias(f"of_{key}"))

        def share(n, d, column):
            """Discounted shares of counts in their context, and the context's weight for
            what is shorter: all, where it was not seen."""
            seen, kinds = _dense(column, langs, "n", "kinds")
            return np.maximum(n - d, 0) / np.maximum(seen, 1), np.where(seen > 0, d * kinds / np.maximum(seen, 1), 1.0)

        def of_pairs(batches):
            for batch in batches:
                (pairs,), (singles,) = _dense(batch.column(1), langs, "n"), _dense(batch.column(3), langs, "n")
                one = np.where(singles > 0, np.maximum(singles - d1, 0) / total, 0.0) + rest
                own, weight = share(pairs, d2, batch.column(2))
                yield pa.RecordBatch.from_arrays([batch.column(0), _vectors(own + weight * one)], ["pair", "short"])

        def of_triples(batches):
            for batch in batches:
                short = batch.column(1).flatten().to_numpy().reshape(len(batch), langs)
                (n,) = _dense(batch.column(2), langs, "n")
                own, weight = share(n, d3, batch.column(3))
                yield pa.RecordBatch.from_arrays([batch.column(0), _vectors(np.log(own + weight * short))], ["gram", "logs"])

        asked = asked.selectExpr("gram", f"shiftright(gram, {_BITS}) AS context", f"gram & {_TWO} AS pair")
        pairs = asked.select("pair").distinct().selectExpr("pair", f"shiftright(pair, {_BITS}) AS first", f"pair & {_ONE} AS single")
        for key, table in (("pair", self.pairs), ("first", self.firsts), ("single", self.singles)):
            pairs = pairs.join(held(table, key), key, "left")
        short = pairs.select("pair", "of_pair", "of_first", "of_single").mapInArrow(of_pairs, "pair long, short array<double>")
        found = asked.join(short, "pair")
        for key, table in (("gram", self.triples), ("context", self.contexts)):
            found = found.join(held(table, key), key, "left")
        return found.select("gram", "short", "of_gram", "of_context").mapInArrow(of_triples, "gram long, logs array<double>")


def _confidence(entropy: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weight of the best language among all. Symbols of a text are not independent: their
    evidence counts as that of the square root of their number, times four."""
    gap = (entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(n, 4 * np.sqrt(n))[:, None]
    return 1 / np.exp(-gap).sum(axis=1)


def train(training: DataFrame) -> Model | Spread:
    """A model of all rows (text, lang), with all their triples."""
    rows = training.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = materialize(count_grams(rows), "grams")
    return Model(counts.toPandas()) if counts.count() <= MODEL_GRAMS else Spread(counts)


_FOUND = "lang_pred string, score double, entropy double, n_symbols long, heads array<struct<lang:string,entropy:double>>"
_HEAD = pa.struct([("lang", pa.string()), ("entropy", pa.float64())])


def _schema(rows: DataFrame, keep: list[str], more: str) -> T.StructType:
    return T.StructType(rows.select(*keep).schema.fields + T.StructType.fromDDL(more).fields)


def _found(langs: list[str], entropy, n, letters, first) -> list[pa.Array]:
    """The columns of _FOUND from what `Model.entropies` returns."""
    best = entropy.argmin(axis=1)
    sure = np.where(letters > 0, _confidence(entropy, n), 0.0)
    least = np.where(letters > 0, entropy.min(axis=1), 0.0)
    names = [langs[k] if some else UNKNOWN for k, some in zip(best, letters > 0)]
    has = ~np.isnan(first[:, :, 0])
    which = np.where(has[:, :, None], first, np.inf).argmin(axis=2)
    low = np.where(has, np.min(np.where(has[:, :, None], first, np.inf), axis=2), 0.0)
    heads = [
        [{"lang": langs[k], "entropy": e} for k, e, h in zip(*x) if h]
        for x in zip(which.tolist(), low.tolist(), has.tolist())
    ]
    return [pa.array(names, pa.string()), pa.array(sure), pa.array(least), pa.array(n), pa.array(heads, pa.list_(_HEAD))]


def score(docs: DataFrame, model: Model | Spread, keep: list[str]) -> DataFrame:
    """The columns `keep` and lang_pred, score, entropy, n_symbols for rows with `text`;
    and `heads`, best language and cross-entropy of the text's first symbols, for each of
    CLASSES that it is long enough for."""
    if isinstance(model, Spread):
        return _score_joined(docs, model, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, "text")
    schema = _schema(rows, keep, _FOUND)

    def work(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            if model.langs:
                found = _found(model.langs, *model.entropies(texts))
            else:
                none = np.zeros(len(texts))
                heads = pa.array([[]] * len(texts), pa.list_(_HEAD))
                found = [pa.array([UNKNOWN] * len(texts), pa.string()), pa.array(none), pa.array(none), pa.array(none.astype(np.int64)), heads]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *found], schema.names)

    return rows.mapInArrow(work, schema)


_PARTS = "number long, gram long, tier int, times long, letters long, symbols array<long>, sums array<double>"
#: Rows of triples to look up that are passed on at a time.
_PASSED = 1 << 16


def _score_joined(docs: DataFrame, model: Spread, keep: list[str]) -> DataFrame:
    """`score` with a model in tables. A pass over the texts writes a row for each with
    what its frequent triples give, and a row for each other triple in it; these meet
    their logarithms in a join and are summed by text."""
    shared = docs.sparkSession.sparkContext.broadcast(model.shared)
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("number"), "text")
    schema = _schema(rows, keep, _PARTS)
    langs, tiers, width = model.langs, len(CLASSES) + 1, len(keep)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]

    def parts(batches):
        model = shared.value
        for batch in batches:
            number = batch.column(width).to_numpy()
            texts = batch.column(width + 1).to_pylist()
            sums, n = np.zeros((len(texts), tiers, len(langs))), np.zeros((len(texts), tiers), np.int64)
            letters = np.zeros(len(texts), np.int64)
            for own, pieces, goes_on in windows(texts):
                symbols = Symbols(pieces, goes_on)
                np.add.at(letters, own, symbols.letters)
                if not len(symbols.gram):
                    continue
                more, count, (text, tier, gram, times) = model.sums(symbols, goes_on, own, len(texts))
                sums, n = sums + more, n + count
                for at in range(0, len(text), _PASSED):
                    some = slice(at, at + _PASSED)
                    told = [number[text[some]], gram[some], tier[some].astype(np.int32), times[some]]
                    size = len(told[0])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[pa.nulls(size, c.type) for c in batch.columns[:width]],
                            *[pa.array(x, t) for x, t in zip(told, kinds)], *[pa.nulls(size, t) for t in kinds[4:]],
                        ], schema.names,
                    )
            empty = [pa.nulls(len(texts), t) for t in kinds[1:4]]
            told = [pa.array(letters), _vectors(n), _vectors(sums.reshape(len(texts), -1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(number), *empty, *told], schema.names)

    for field in schema.fields:
        field.nullable = True
    written = materialize(rows.mapInArrow(parts, schema), "language-parts")
    asked = written.where("gram IS NOT NULL").select("number", "tier", "gram", "times")
    logs = model.logarithms(asked.select("gram").distinct())
    summed = [F.sum(-F.col("logs")[k] * F.col("times")).alias(f"s{k}") for k in range(len(langs))]
    rest = asked.join(logs, "gram").groupBy("number", "tier").agg(*summed)
    rest = rest.groupBy("number").agg(
        F.collect_list(F.struct(F.col("tier").alias("k"), F.array(*[f"s{k}" for k in range(len(langs))]).alias("sums"))).alias("rest")
    )
    texts = written.where("gram IS NULL").select(*keep, "number", "letters", "symbols", "sums").join(rest, "number", "left")
    final = _schema(rows, keep, _FOUND)

    def whole(batches):
        for batch in batches:
            letters, symbols, sums, rest = batch.columns[width:]
            size = len(batch)
            n = symbols.flatten().to_numpy().reshape(size, tiers)
            total = sums.flatten().to_numpy().reshape(size, tiers, len(langs)).copy()
            held = rest.flatten()
            at = np.repeat(np.arange(size), pc.fill_null(pc.list_value_length(rest), 0).to_numpy(zero_copy_only=False))
            more = pc.struct_field(held, "sums").flatten().to_numpy().reshape(len(held), len(langs))
            total[at, pc.struct_field(held, "k").to_numpy()] += more
            upto, there = np.cumsum(total, axis=1), np.cumsum(n, axis=1)
            sizes = np.array(CLASSES)
            first = np.where((there[:, :-1] >= sizes)[:, :, None], upto[:, :-1] / sizes[:, None], np.nan)
            entropy = upto[:, -1] / np.maximum(there[:, -1:], 1)
            found = _found(langs, entropy, there[:, -1].copy(), letters.to_numpy(), first)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *found], final.names)

    return texts.select(*keep, "letters", "symbols", "sums", "rest").mapInArrow(whole, final)


def limits(scored: DataFrame) -> tuple[DataFrame, list[float | None]]:
    """(lang, l0, l1, ...): the cross-entropy beyond which a text of a length class is not
    of its language, from what the first symbols of all learned texts have; and the same
    over all languages, a number per class. Null where no text is so long."""
    heads = scored.where("learned").select(F.posexplode("heads").alias("class", "h")).select("class", "h.*")
    middle, high = (F.percentile_approx("entropy", q, F.lit(10_000)) for q in (0.5, 0.95))
    limit = (middle + F.greatest(SPREAD * (high - middle), F.lit(LEAST_SLACK))).alias("limit")
    classes = range(len(CLASSES))
    of_lang = heads.groupBy("lang", "class").agg(limit).groupBy("lang").agg(
        *[F.max(F.when(F.col("class") == c, F.col("limit"))).alias(f"l{c}") for c in classes]
    )
    of_all = {r["class"]: r["limit"] for r in heads.groupBy("class").agg(limit).collect()}
    return of_lang, [of_all.get(c) for c in classes]


def identify(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
    carry: bool = False,
) -> DataFrame:
    """One row per row of `docs`: id, held_out, lang_pred, score, entropy, rejected.

    Rows whose crc32 of the id as text is a multiple of `folds` are held out; the models
    are counted over all other rows with a language, and only their text and language
    are used. The language of least cross-entropy per symbol is chosen; `und` for a null
    text or one without letters, or if there is nothing to learn from. A text is rejected
    if its cross-entropy is beyond the limit of its language for texts of its length
    (`limits`; shorter ones than the least of CLASSES go by that); `und` always is. The
    score is the weight of the language among all, less the further the text is beyond
    its limit. A null id is held out with the id text as empty. Repeated rows are
    repeated, and counted each. With `carry` the whole row goes along as `doc`: texts are
    then scored a second time rather than written to a table with their scores; where the
    model is in tables, rows are written with numbers and joined with what was found.
    """
    rows = docs.select(
        *([F.struct("*").alias("doc")] if carry else []), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0).alias("held_out"),
    )
    model = train(rows.where("NOT held_out"))
    rows = rows.withColumn("learned", F.expr("NOT held_out AND lang IS NOT NULL"))
    joined = carry and isinstance(model, Spread)
    if joined:
        rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "language-rows")
    scored = materialize(score(rows, model, ["id", "held_out", "learned"] + ["row"] * joined), "languages")
    own, others = limits(scored)
    own = materialize(own.withColumnRenamed("lang", "lang_pred"), "language-limits")  # a row per language
    if joined:
        scored = scored.join(rows.select("row", "doc"), "row")
    elif carry:
        scored = score(rows, model, ["doc", "id", "held_out"])
    judged = scored.join(own, "lang_pred", "left")
    # The limit of the text's class, or else of the longest one below that is known.
    limit = F.lit(float("inf"))
    for known in ([F.lit(x).cast("double") for x in others], [F.col(f"l{c}") for c in range(len(CLASSES))]):
        for c, value in enumerate(known):
            fits = value.isNotNull() & (F.col("n_symbols") >= (CLASSES[c] if c else 0))
            limit = F.when(fits, value).otherwise(limit)
    beyond = F.col("entropy") > limit
    less = F.when(beyond, F.pow(limit / F.col("entropy"), F.lit(8.0))).otherwise(1.0)
    return judged.select(
        *["doc"] * carry, "id", "held_out", "lang_pred", (F.col("score") * less).alias("score"), "entropy",
        ((F.col("lang_pred") == UNKNOWN) | beyond).alias("rejected"),
    )
