"""Secret scan with DataFrame functions only.

Base rules (assign, access, hex) are regular expressions. The method adds spans:
runs of 20 and more key characters with a digit and a letter are read by two
character Markov models, one of random strings, one of ordinary identifiers; a
run is a secret if the log-likelihood ratio is at least ``MIN_RATIO`` in all and
``MIN_MEAN`` a transition, and it touches no base span. Both models are counted
over labelled samples: the values that the base rules find and strings of random
bits (digests in hexadecimal, base 64 and base 36) against the words of the same
``sample_docs`` documents, the bound of the sample.

Positions are code points. A match's position comes from the lengths of the
pieces between matches, summed in blocks, so a text with many matches costs
little more than its length.

Defined results: null text is the empty text and holds nothing; repeated rows are
scanned each; an empty table gives no rows and trains two uniform models; a null
doc_id is kept; ``redact`` keeps all columns, ``report`` ignores other columns."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrec.llm.common import free_name

#: The base rules as (kind, pattern, group, least length of the group).
RULES = (
    ("assign", "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
)
KEY_RUN = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "+/_=-"
K = len(ALPHABET)
MIN_RATIO, MIN_MEAN = 20.0, 0.8
MANY = 200  # spans of a text from which redact cuts it into characters
BLOCK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def before(values: Column, zero: Column, op: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """For each element, ``op`` over those before it: within its block, and over the
    blocks before, which are treated alike, so the work is linear in the size."""
    total = lambda v: F.aggregate(v, zero, op)
    if levels == 0:
        return let(values, lambda v: F.transform(v, lambda x, i: total(F.slice(v, F.lit(1), i))))

    def within(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                             lambda b: total(F.slice(v, b * BLOCK + 1, F.lit(BLOCK))))
        return let(before(blocks, zero, op, levels - 1), lambda t: F.transform(v, lambda x, i: op(
            F.get(t, F.floor(i / BLOCK).cast("int")), total(F.slice(v, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)))))

    return let(values, lambda v: F.when(F.size(v) > 0, within(v)).otherwise(F.array().cast("array<int>")))


def sums_before(values: Column) -> Column:
    return before(values, F.lit(0), lambda s, x: s + x)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """[(start, end, value)] of the leftmost non-overlapping matches; ``value``
    is the group's string."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

    def place(s: Column) -> Column:
        gap, size = s["gap"], s["size"]
        steps = F.zip_with(F.slice(gap, F.lit(1), F.size(size)), size, lambda a, b: a + b)
        return let(sums_before(steps), lambda before: F.transform(size, lambda n, i: F.struct(
            (F.get(before, i) + F.get(gap, i)).alias("start"), (F.get(before, i) + F.get(gap, i) + n).alias("end"),
            F.get(s["value"], i).alias("value"))))

    whole = F.struct(gaps.alias("gap"), F.transform(found, lambda x: F.length(x)).alias("size"), values.alias("value"))
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), let(whole, place)).otherwise(nothing)


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _named(found: Column, rank: int, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
                                                 F.lit(kind).alias("kind"))).cast(SPANS)


def _at_least(found: Column, least: int) -> Column:
    return F.filter(found, lambda m: F.length(m["value"]) >= least)


def base_spans(text: Column) -> list[Column]:
    """One array of (start, rank, end, kind) for each rule."""
    return [_named(_at_least(matches(text, pattern, group), least), rank, kind)
            for rank, (kind, pattern, group, least) in enumerate(RULES)]


def train(docs: DataFrame, sample_docs: int = 3000) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of each transition,
    K * K numbers, from the sample."""
    ids = docs.where("doc_id is not null and text is not null").select("doc_id").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # sample_docs ids at most
    values = [F.transform(matches(F.col("text"), p, g), lambda m: m["value"]) for _, p, g, _ in RULES]
    bits = F.sha2(F.col("doc_id").cast("string").cast("binary"), 256)
    digests = F.array(bits, F.base64(F.unhex(bits)), F.upper(F.conv(F.substring(bits, 1, 15), 16, 36)),
                      F.translate(F.base64(F.unhex(F.reverse(bits))), "+/", "Zz"))
    clean = texts.withColumn("random", F.concat(digests, *[F.filter(v, lambda x: F.length(x) >= 6) for v in values]))
    words = F.filter(F.split(F.regexp_replace("text", "|".join(f"(?:{p})" for _, p, _, _ in RULES), " "), "[^A-Za-z0-9_-]+"),
                     lambda w: F.length(w) >= 4)
    rows = clean.select(F.lit(1).alias("y"), F.explode("random").alias("s")).unionByName(
        texts.select(F.lit(0).alias("y"), F.explode(words).alias("s")))
    pairs = rows.where(F.length("s") >= 2).select("y", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substr(F.col("s"), i, F.lit(2)))).alias("pair"))
    counts = {(r.y, r.pair): r["count"] for r in pairs.where(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$"))
              .groupBy("y", "pair").count().collect()}  # at most 2 K K rows
    ratios = []
    for a in ALPHABET:
        p = []
        for y in (0, 1):
            total = sum(counts.get((y, a + b), 0) for b in ALPHABET)
            p.append([(counts.get((y, a + b), 0) + 0.5) / (total + 0.5 * K) for b in ALPHABET])
        ratios += [math.log(q / o) for o, q in zip(*p)]
    return ratios


def ratio(value: Column, model: list[float]) -> Column:
    """Sum of the transitions' log-likelihood ratios."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")  # folded to one constant
    codes = F.split(F.lit(",".join(str(ALPHABET.find(chr(c))) for c in range(128))), ",").cast("array<int>")
    return let(F.transform(F.split(value, ""), lambda c: F.get(codes, F.ascii(c))), lambda at: F.aggregate(
        F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0),
        lambda s, i: s + F.coalesce(F.get(table, F.get(at, i - 1) * K + F.get(at, i)), F.lit(0.0))))


def markov_spans(text: Column, model: list[float]) -> Column:
    runs = F.filter(matches(text, KEY_RUN), lambda m: m["value"].rlike("[0-9]") & m["value"].rlike("[A-Za-z]"))
    random = F.filter(runs, lambda m: let(ratio(m["value"], model), lambda r: (r >= MIN_RATIO) & (
        r >= MIN_MEAN * (F.length(m["value"]) - 1))))
    return _named(random, len(RULES), "markov")


def _apart(more: Column, base: Column) -> Column:
    """The spans of ``more`` that overlap none of ``base``: in the order of where the
    first end and the others start, all base spans that could overlap come before."""
    event = "array<struct<at:int,rank:int,low:int,high:int,span:struct<start:int,rank:int,end:int,kind:string>>>"
    ends = F.transform(more, lambda m: F.struct(m["end"].alias("at"), F.lit(0).alias("rank"), m["start"].alias("low"),
                                                F.lit(0).alias("high"), m.alias("span"))).cast(event)
    starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("rank"), b["start"].alias("low"),
                                                  b["end"].alias("high"), b.alias("span"))).cast(event)

    def free(events: Column) -> Column:
        reached = before(F.transform(events, lambda e: e["high"]), F.lit(0), lambda a, b: F.greatest(a, b))
        tagged = F.zip_with(events, reached, lambda e, high: F.when((e["rank"] == 0) & (high <= e["low"]), e["span"]))
        return F.filter(tagged, lambda m: m.isNotNull())

    return F.when((F.size(more) > 0) & (F.size(base) > 0), let(F.array_sort(F.concat(ends, starts)), free)).otherwise(more)


def scan(docs: DataFrame, model: list[float] | None = None, name: str = "_secrets") -> DataFrame:
    """``docs`` with a column ``name``: ``base`` (one array of spans per rule) and
    ``spans`` (all spans by start, then rule)."""
    model = model or train(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn(name, F.struct(F.array(*base_spans(text)).alias("base"), markov_spans(text, model).alias("more")))
    base = F.flatten(F.col(f"{name}.base"))
    return out.withColumn(name, F.struct(F.col(f"{name}.base").alias("base"), F.array_sort(F.concat(
        base, _apart(F.col(f"{name}.more"), base))).alias("spans")))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    found = scan(docs.select("doc_id", "text"), model or train(docs))
    counts = [F.size(F.get("_secrets.base", F.lit(i))).cast("long").alias(f"n_{kind}") for i, (kind, *_) in enumerate(RULES)]
    base = _listed(F.array_sort(F.flatten("_secrets.base")))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        _listed(F.col("_secrets.spans")).alias("spans"))


def redact(docs: DataFrame, model: list[float] | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span's text replaced; overlapping and touching spans are
    one."""
    name = free_name(docs, "_secrets")
    text, spans = F.col("text"), F.col(f"{name}.spans")

    def clear(cut: Callable[[Column, Column], Column], rest: Callable[[Column], Column]) -> Column:
        """Marks between what ``cut`` gives of [start, end) and ``rest`` from a start."""
        def rewrite(first: Column) -> Column:  # the first span of each joined one, and where those before it end
            parts = F.transform(first, lambda x: cut(x["reached"], x["start"]))
            return F.concat(F.array_join(parts, mark), F.lit(mark), rest(F.array_max(F.transform(spans, lambda s: s["end"]))))

        reached = before(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
        both = F.zip_with(spans, reached, lambda s, r: F.struct(s["start"].alias("start"), r.alias("reached")))
        # nothing lies before the first span, which may start at 0
        firsts = F.filter(both, lambda x, i: (i == 0) | (x["start"] > x["reached"]))
        return let(firsts, rewrite)

    few = clear(lambda a, b: F.substr(text, a + 1, b - a), lambda a: F.substr(text, a + 1))
    # a substring is found by walking from the text's start: with many spans the text is cut into characters once
    many = let(F.split(text, ""), lambda chars: clear(
        lambda a, b: F.array_join(F.slice(chars, a + 1, b - a), ""),
        lambda a: F.array_join(F.slice(chars, a + 1, F.greatest(F.size(chars) - a, F.lit(0))), "")))
    out = F.when(F.size(spans) > MANY, many).when(F.size(spans) > 0, few).otherwise(text)
    return scan(docs, model, name).withColumn("text", out).select(*[F.col(f"`{c}`") for c in docs.columns])
