"""Quality by the perplexity of a modified Kneser-Ney model of characters.

Text is read as it is: the commonest characters of the trusted texts, capitals, digits and
white space among them, have a symbol each. Every other character of the trusted texts is
spelled: a mark and its number among them, in symbols, as many as their count needs (none if
there are no such characters). Of characters that no trusted text has, only the kind is known:
upper case, digits and white space have a symbol a kind, all others share number 0.
An n-gram is the base-64 number of its symbols. Tasks count n-grams of trusted texts, Spark
adds the counts by (language, n-gram) and derives continuation counts, discounts and
back-off weights by aggregations and joins on (language, context). The tables are bounded
by 64 ** ORDER entries a language however large the corpus is; up to ``BROADCAST_ROWS``
they go to the tasks as arrays, beyond it the n-gram counts of each text are joined with
them by a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow, written
from roadstream.plans import fits_broadcast

ORDER = 4
BITS = 6
#: Symbols: 0 is a text's edge, 4 the mark of a rare character; 1 white space, 2 upper case and
#: 3 digits that no trusted text has.
EDGE, SPACE, UPPER, DIGIT, RARE = range(5)
LETTERS = 64 - 5
#: Symbols that spell a number; an edge is none of them.
SPELLING = 64 - 1
BROADCAST_ROWS = 6_000_000
#: Width of the bins of log perplexity in which quantiles are counted.
BIN = 0.001
#: The model of all languages, for texts whose language has none.
POOLED = "*"


def quality(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = 0.99,
    slack: float = 0.06,
    broadcast_rows: int = BROADCAST_ROWS,
    keep_rows: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``lang``, ``perplexity``, ``threshold``, ``kept``, with
    ``keep_rows`` the row itself and else its columns in ``carry`` as the struct ``row``.

    ``trusted`` lists, in its ``id_col``, the rows whose text is of good quality. A
    language's model and its threshold come from its trusted texts; the threshold is the
    given quantile of their log perplexities plus ``slack``, and a text above it is not
    kept. A text whose language is null or has no trusted text is measured with the model
    and threshold of all trusted texts. Perplexity is taken per character, however many
    symbols spell it. Null and empty texts have no perplexity and are
    not kept; if there is no trusted text at all, every other text is kept. Repeated rows
    are scored alike; a null id is never trusted. Other columns are not read.
    """
    ids = trusted.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    ids = ids.withColumn("trusted", F.lit(True))
    ids = F.broadcast(ids) if fits_broadcast(ids) else ids
    columns = docs.columns if keep_rows else carry
    work = (
        docs.select(
            F.col(id_col).alias("id"),
            F.col(text_col).alias("text"),
            F.col(lang_col).alias("lang"),
            *([F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")] if columns else []),
        )
        .join(ids, "id", "left")
        .withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    )
    good = work.where("trusted and length(text) > 0")
    alphabet = _alphabet(good)
    model = train(good, alphabet)
    scored = written(_scores(work, alphabet, model, _arrays(model, broadcast_rows)))
    return _judged(scored, thresholds(scored.where("trusted"), quantile, slack))


def _judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    own = limits.where(F.col("model") != POOLED)
    pooled = limits.where(F.col("model") == POOLED).select(F.col("log_limit").alias("_pooled"))
    # One row per language and one in all: as small as the label set.
    joined = (
        scored.join(F.broadcast(own), "model", "left")
        .join(F.broadcast(pooled), F.lit(True), "left")
    )
    limit = F.coalesce("log_limit", "_pooled")
    log_p = F.col("log_perplexity")
    return joined.select(
        "id",
        "lang",
        *(["row"] if "row" in scored.columns else []),
        F.exp(log_p).alias("perplexity"),
        F.exp(limit).alias("threshold"),
        (log_p.isNotNull() & F.coalesce(log_p <= limit, F.lit(True))).alias("kept"),
    )


# --- symbols ---------------------------------------------------------------------------


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_FOLD: np.ndarray | None = None


def _fold() -> np.ndarray:
    """Code point to folded code point: upper case to A, digits to 0, white space to " ". It
    tells the kind of characters that no trusted text has, and is not applied to others."""
    global _FOLD
    if _FOLD is None:
        fold = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))
            if kind in ("Lu", "Lt"):
                fold[c] = ord("A")
            elif kind == "Nd":
                fold[c] = ord("0")
            elif kind in ("Zs", "Zl", "Zp") or 9 <= c <= 13:
                fold[c] = 32
        _FOLD = fold
    return _FOLD


def _alphabet(texts: DataFrame) -> list[int]:
    """The characters of the texts, the commonest first. There are at most as many as code
    points, however large the texts."""

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        total = np.zeros(0x110000, np.int64)
        for b in batches:
            joined = _code_points("".join(b["text"].to_pylist()))
            total += np.bincount(joined, minlength=len(total))
        seen = np.flatnonzero(total)
        yield {"c": seen, "n": total[seen]}

    counts = in_arrow(texts.select("text"), "c long, n long", count)
    top = counts.groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c")
    return [r["c"] for r in top.collect()]


def _symbols(alphabet: list[int]) -> np.ndarray:
    """Code point to symbol; above the symbol's bits stands the number of a rare character."""
    kind = np.full(0x110000, RARE, np.int32)
    kind[ord("A")], kind[ord("0")], kind[32] = UPPER, DIGIT, SPACE
    to = kind[_fold()]
    for i, c in enumerate(alphabet[:LETTERS]):
        to[c] = RARE + 1 + i
    rare = alphabet[LETTERS:]
    to[rare] = RARE | np.arange(1, len(rare) + 1, dtype=np.int32) << BITS
    return to


def _spelled(alphabet: list[int]) -> int:
    """How many symbols spell the number of a rare character."""
    most, width = max(0, len(alphabet) - LETTERS), 0
    while SPELLING**width <= most:
        width += 1
    return width


def _grams(
    texts: list[str | None], symbol: np.ndarray, spelled: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each symbol, and the number of symbols per text."""
    lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
    edge = "\0" * (ORDER - 1)
    joined = edge + edge.join(t or "" for t in texts)
    s = symbol[_code_points(joined)].astype(np.int32)
    # A text's own NUL characters must not look like its edge.
    ends = np.cumsum(lengths + (ORDER - 1))
    inside = np.zeros(len(s) + 1, np.int32)
    np.add.at(inside, ends - lengths, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    s[~inside] = EDGE
    if spelled:
        number, s = s >> BITS, s & ((1 << BITS) - 1)
        rare = s == RARE
        before = np.concatenate([[0], np.cumsum(rare)])
        lengths = lengths + spelled * (before[ends] - before[ends - lengths])
        times = np.where(rare, 1 + spelled, 1)
        s, inside, marks = np.repeat(s, times), np.repeat(inside, times), (np.cumsum(times) - times)[rare]
        for place in range(1, spelled + 1):
            s[marks + place] = 1 + number[rare] // SPELLING ** (spelled - place) % SPELLING
    code = s.copy()
    for back in range(1, ORDER):
        code[back:] |= s[:-back] << (BITS * back)
    return code[inside], lengths


# --- training --------------------------------------------------------------------------


def train(texts: DataFrame, alphabet: list[int]) -> DataFrame:
    """The model as rows (model, order, code, p, back).

    ``p`` is the interpolated probability of the n-gram's last symbol after the others,
    ``back`` the weight of the shorter context where ``code`` is the context (null where
    it is none). Orders below the highest use continuation counts.
    """

    shared = texts.sparkSession.sparkContext.broadcast((_symbols(alphabet), _spelled(alphabet)))

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            text, lang = b["text"].to_pylist(), b["lang"].to_pylist()
            for name in sorted({x for x in lang if x is not None}) + [None]:
                mine = [t for t, x in zip(text, lang, strict=True) if x == name]
                if mine:
                    code, n = np.unique(_grams(mine, *shared.value)[0], return_counts=True)
                    yield {"model": pa.array([name] * len(code), pa.string()), "code": code, "n": n}

    raw = in_arrow(texts.select("text", "lang"), "model string, code int, n long", count)
    by_lang = written(raw.groupBy("model", "code").agg(F.sum("n").alias("n")))
    pooled = by_lang.groupBy("code").agg(F.sum("n").alias("n"))
    counts = {
        ORDER: by_lang.where(F.col("model").isNotNull() & (F.col("model") != POOLED))
        .unionByName(pooled.withColumn("model", F.lit(POOLED)))
        .select("model", "code", "n")
    }
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("code").bitwiseAND((1 << (BITS * order)) - 1)
        counts[order] = (
            counts[order + 1]
            .groupBy("model", suffix.alias("code"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
    lower = None
    for order in range(1, ORDER + 1):
        lower = written(_interpolated(counts[order], order, lower))
        level = lower.withColumn("order", F.lit(order))
        model = level if order == 1 else model.unionByName(level)
    return model


def _interpolated(counts: DataFrame, order: int, lower: DataFrame | None) -> DataFrame:
    """(model, code, p) of one order and, in the same rows, ``back`` of the contexts of
    the next lower length: a row's context may itself be no n-gram, so contexts have rows
    of their own with a null ``p``."""
    ones = counts.groupBy("model").agg(
        *[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    )
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def discount(k: int):
        d = k - (k + 1) * y * F.try_divide(f"n{k + 1}", f"n{k}")
        # Too few n-grams for the formula: half a count.
        return F.when((d > 0) & (d < k), d).otherwise(0.5)

    rates = ones.select("model", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
    # One row a language.
    known = counts.join(F.broadcast(rates), "model").withColumn(
        "ctx", F.shiftright("code", BITS)
    )
    n = F.col("n")
    off = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
    known = known.withColumn("off", off)
    ctx = known.groupBy("model", "ctx").agg(
        F.sum("n").alias("total"), F.sum("off").alias("held")
    )
    ctx = ctx.withColumn("back", F.col("held") / F.col("total"))
    rows = known.join(ctx, ["model", "ctx"])
    alpha = (n - F.col("off")) / F.col("total")
    if lower is None:
        p = alpha + F.col("back") / F.lit(float((1 << BITS) - 1))
        grams = rows.select("model", "code", p.alias("p"))
    else:
        suffix = F.col("code").bitwiseAND((1 << (BITS * (order - 1))) - 1)
        below = lower.where("p is not null").select("model", F.col("code").alias("_s"), F.col("p").alias("_p"))
        grams = rows.withColumn("_s", suffix).join(below, ["model", "_s"], "left")
        # A lower n-gram of a counted one has been counted, too.
        grams = grams.select("model", "code", (alpha + F.col("back") * F.col("_p")).alias("p"))
    backs = ctx.select("model", F.col("ctx").alias("code"), "back")
    return grams.withColumn("back", F.lit(None).cast("double")).unionByName(
        backs.withColumn("p", F.lit(None).cast("double"))
    )


# --- scoring ---------------------------------------------------------------------------


def _arrays(model: DataFrame, most: int):
    """The model as arrays, or None if it has more than ``most`` rows."""
    if model.count() > most:
        return None
    got = model.toArrow().to_pandas()
    return {
        name: {
            int(order): (
                rows.loc[rows["p"].notna(), ["code", "p"]].to_numpy(),
                rows.loc[rows["back"].notna(), ["code", "back"]].to_numpy(),
            )
            for order, rows in own.groupby("order")
        }
        for name, own in got.groupby("model")
    }


class _Scorer:
    """Dense tables up to trigrams; 4-grams by an index that all languages share."""

    def __init__(self, tables: dict):
        self.names = {name: i for i, name in enumerate(sorted(tables))}
        self.low, self.back, tops = [], [], []
        uniform = 1.0 / ((1 << BITS) - 1)
        for name in sorted(tables):
            p = np.full(1, uniform)
            for order in range(1, ORDER + 1):
                grams, backs = tables[name][order]
                weight = np.ones(1 << (BITS * (order - 1)))
                weight[backs[:, 0].astype(np.int64)] = backs[:, 1]
                if order == ORDER:
                    self.low.append(np.log(p).astype(np.float32))
                    self.back.append(np.log(weight).astype(np.float32))
                    tops.append(grams)
                else:
                    code = np.arange(1 << (BITS * order))
                    p = weight[code >> BITS] * p[code & ((1 << (BITS * (order - 1))) - 1)]
                    p[grams[:, 0].astype(np.int64)] = grams[:, 1]
        codes = np.unique(np.concatenate([t[:, 0] for t in tops])).astype(np.int64)
        self.index = np.zeros(1 << (BITS * ORDER), np.int32)
        self.index[codes] = np.arange(1, len(codes) + 1)
        self.top = np.full((len(tops), len(codes) + 1), np.nan, np.float32)
        for i, grams in enumerate(tops):
            self.top[i, self.index[grams[:, 0].astype(np.int64)]] = np.log(grams[:, 1])

    def log_p(self, code: np.ndarray, model: int) -> np.ndarray:
        got = self.top[model][self.index[code]]
        miss = np.flatnonzero(np.isnan(got))
        c = code[miss]
        got[miss] = self.back[model][c >> BITS] + self.low[model][c & ((1 << (BITS * (ORDER - 1))) - 1)]
        return got


def _scores(docs: DataFrame, alphabet: list[int], model: DataFrame, tables) -> DataFrame:
    """(id, lang, model, log_perplexity); null where there is no text or no model."""
    if tables is None:
        return _joined_scores(docs, alphabet, model)
    carried = [c for c in ("id", "lang", "trusted", "row") if c in docs.columns]
    schema = StructType([docs.schema[c] for c in carried])
    schema = schema.add("model", "string").add("log_perplexity", "double")
    shared = docs.sparkSession.sparkContext.broadcast((_symbols(alphabet), _spelled(alphabet), tables))

    def score(batches: Iterator[dict]) -> Iterator[dict]:
        symbol, spelled, tables = shared.value
        if not tables:
            for b in batches:
                n = len(b["text"])
                zero = [0.0 if t else None for t in b["text"].to_pylist()]
                none = pa.nulls(n, pa.string())
                yield {**{c: b[c] for c in carried}, "model": none, "log_perplexity": zero}
            return
        scorer = _Scorer(tables)
        for b in batches:
            text, lang = b["text"].to_pylist(), b["lang"].to_pylist()
            names = [x if x in scorer.names else POOLED for x in lang]
            out = np.full(len(text), np.nan)
            for name in sorted(set(names)):
                at = np.array([i for i, x in enumerate(names) if x == name and text[i]], int)
                if len(at):
                    code, lengths = _grams([text[i] for i in at], symbol, spelled)
                    log_p = scorer.log_p(code, scorer.names[name])
                    starts = np.cumsum(lengths) - lengths
                    out[at] = -np.add.reduceat(log_p.astype(np.float64), starts) / [len(text[i]) for i in at]
            yield {
                **{c: b[c] for c in carried},
                "model": names,
                "log_perplexity": pa.array(out, pa.float64(), mask=np.isnan(out)),
            }

    return in_arrow(docs.select(*carried, "text"), schema, score)


def _joined_scores(docs: DataFrame, alphabet: list[int], model: DataFrame) -> DataFrame:
    """The same by joins: n-gram counts of each text with the model, shuffled."""
    names = model.select("model").distinct().withColumn("_known", F.lit(True))
    shared = docs.sparkSession.sparkContext.broadcast((_symbols(alphabet), _spelled(alphabet)))
    tagged = (
        docs.withColumn("model", F.col("lang"))
        .join(F.broadcast(names), "model", "left")
        .withColumn("model", F.when(F.col("_known"), F.col("lang")).otherwise(POOLED))
        .withColumn("_no", F.expr("uuid()"))
    )
    rows = written(tagged)

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for no, name, text in zip(
                b["_no"].to_pylist(), b["model"].to_pylist(), b["text"].to_pylist(), strict=True
            ):
                if text:
                    code, n = np.unique(_grams([text], *shared.value)[0], return_counts=True)
                    k = len(code)
                    yield {"_no": [no] * k, "model": [name] * k, "code": code, "n": n}

    grams = in_arrow(rows.select("_no", "model", "text"), "_no string, model string, code int, n long", count)
    grams = written(grams)
    p = _resolved(grams.select("model", "code").distinct(), model, ORDER)
    sums = (
        grams.join(p, ["model", "code"])
        .groupBy("_no")
        .agg((-F.sum(F.col("n") * F.log("p"))).alias("_cost"))
    )
    scored = rows.join(sums, "_no", "left").withColumn("log_perplexity", F.col("_cost") / F.length("text"))
    return scored.drop("text", "_known", "_no", "_cost")


def _resolved(codes: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """(model, code, p) for any n-grams: the shorter context's share where one is new."""
    if order == 0:
        return codes.withColumn("p", F.lit(1.0 / ((1 << BITS) - 1)))
    level = model.where(F.col("order") == order)
    seen = level.where("p is not null").select("model", "code", "p")
    backs = level.where("back is not null").select("model", F.col("code").alias("_c"), "back")
    suffix = F.col("code").bitwiseAND((1 << (BITS * (order - 1))) - 1)
    both = codes.withColumn("_s", suffix).withColumn("_c", F.shiftright("code", BITS))
    shorter = _resolved(
        both.select("model", F.col("_s").alias("code")).distinct(), model, order - 1
    ).select("model", F.col("code").alias("_s"), F.col("p").alias("_lower"))
    return (
        both.join(seen, ["model", "code"], "left")
        .join(backs, ["model", "_c"], "left")
        .join(shorter, ["model", "_s"])
        .select(
            "model",
            "code",
            F.coalesce("p", F.coalesce("back", F.lit(1.0)) * F.col("_lower")).alias("p"),
        )
    )


def thresholds(scored: DataFrame, quantile: float, slack: float) -> DataFrame:
    """(model, log_limit): a quantile of log perplexity, counted in bins of width BIN."""
    binned = scored.where("log_perplexity is not null").select(
        F.explode(F.array(F.col("model"), F.lit(POOLED))).alias("model"),
        F.ceil(F.col("log_perplexity") / BIN).alias("bin"),
    )
    counts = binned.groupBy("model", "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("model")
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    at = counts.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(w))
    return (
        at.where(F.col("_upto") >= F.lit(quantile) * F.col("_all"))
        .groupBy("model")
        .agg((F.min("bin") * BIN + slack).alias("log_limit"))
    )
