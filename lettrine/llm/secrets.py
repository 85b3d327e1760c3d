"""Secrets in whole texts, with DataFrame functions only.

Three rules find assigned values, access keys and long hex strings. Beyond them
two character Markov models, one of random strings and one of ordinary
identifiers, are compared by the mean log-likelihood ratio of a string's
character pairs; what the rules' spans leave of a string of at least
``MIN_LENGTH`` characters is a secret of kind ``random`` if its mean ratio reaches
``MIN_RATIO`` and its whole ratio ``MIN_TOTAL``, so a shorter one needs a higher
mean; as ordinary words show no signs, a shorter one
has letters and digits, both and nothing else, so numbers aren't meant. The models are counted on a sample of about ``max_docs`` documents
by hash: what the rules find there and as many digests of the texts, in
upper-case hex and in base64, are labelled random, other words ordinary.

Work grows with a text's length and, for its n spans, with n times the root of n.

Spans are in code points, end exclusive. Null texts count as empty and have no
spans. Without ordinary words the models are flat and add no span. Repeated
rows give repeated results, ties play no part, an empty table gives no rows;
columns named like the added ones are replaced, all others kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import fresh

# The rules' patterns, the group that counts and its least length.
RULES = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
#: Cheap tests of whether a rule can hold at all.
HINTS = {"assign": r"(?i)pass|secret|token|api", "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
MIN_LENGTH = 12
MIN_RATIO = 1.0
MIN_TOTAL = 19.0
MASK = "[SECRET]"
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"
#: Characters of found spans are moved to twins in a private area of Unicode, one for one, so that positions stay.
PLAIN = "".join(map(chr, range(33, 127)))
TWINS = "".join(chr(0xE000 + ord(c)) for c in PLAIN)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def groups(items: Column) -> Column:
    """The items in order, in about as many groups as a group has items: arrays that grow item by item stay short."""
    def cut(all_: Column) -> Column:
        n = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(all_))).cast("int"))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(all_, i * n + 1, n))

    return bound(items, cut)


def pieces(text: Column, pattern: str, group: int) -> Column:
    """What stands between the matches of the pattern (gap), the match after it and the match's group (value); the last gap has no match."""
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("match"), F.regexp_extract_all(text, F.lit(pattern), group).alias("value"))


def found(text: Column, pattern: str, kind: str, rank: int, group: int = 0, least: int = 1, hint: str | None = None) -> Column:
    """Spans of all leftmost matches whose group has at least ``least`` characters.

    The text split at the pattern gives what stands between the matches, so the
    lengths add up to positions.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.coalesce(F.char_length(x["match"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.char_length(x["value"]) >= least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def walk(acc: Column, some: Column) -> Column:
        inner = F.aggregate(some, F.struct(acc["at"].alias("at"), F.array().cast(SPAN).alias("out")), step)
        return bound(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")))

    return F.when(F.regexp_like(text, F.lit(hint or pattern)), F.aggregate(groups(pieces(text, pattern, group)), start, walk, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def rule_spans(text: Column) -> Column:
    return F.array_sort(F.concat(*[found(text, p, kind, rank, group, least, HINTS[kind]) for rank, (kind, (p, group, least)) in enumerate(RULES.items())]))


def twinned(pattern: str) -> str:
    """The pattern of characters and classes, for text some of whose characters are moved to their twins."""
    move = lambda c: chr(0xE000 + ord(c))
    classes = re.findall(r"\[([^]]+)\]|(\w)|(\+)", pattern)
    return "".join(plus or f"[{c or one}{re.sub(r'[^-]', lambda m: move(m[0]), c or one)}]" for c, one, plus in classes)


def uncovered(text: Column) -> Column:
    """The text with all that the rules' spans cover moved to the twins.

    Access keys and hex are found in what is partly moved as in the text itself.
    """
    for kind, (pattern, group, least) in RULES.items():
        pattern, hint = (pattern, HINTS[kind]) if kind == "assign" else (twinned(pattern), twinned(pattern))
        part = lambda x: F.concat(x["gap"], F.when(F.char_length(x["value"]) >= least, F.translate(x["match"], PLAIN, TWINS)).otherwise(F.coalesce(x["match"], F.lit(""))))  # noqa: B023, E731
        text = F.when(F.regexp_like(text, F.lit(hint)), F.array_join(F.transform(pieces(text, pattern, group), part), "")).otherwise(text)
    return text


def _pairs(string: Column) -> Column:
    """Numbers of a string's pairs of characters, both ASCII."""
    codes = F.transform(F.split(string, ""), lambda c: F.ascii(c))
    return bound(codes, lambda c: F.transform(F.sequence(F.lit(0), F.char_length(string) - 2), lambda i: F.get(c, i) * 128 + F.get(c, i + 1)))


def learn(docs: DataFrame, max_docs: int = 5000) -> list[float]:
    """Log-likelihood ratios of all pairs of ASCII characters, random against ordinary."""
    n = docs.count()
    share = min(1.0, max_docs / max(1, n))
    text = F.coalesce("text", F.lit(""))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))).select(text.alias("text"), rule_spans(text).alias("spans"))
    times = max(1, max_docs // max(1, n))  # so that few documents make as many strings
    digests = F.transform(F.sequence(F.lit(1), F.lit(times)), lambda i: F.sha2(F.concat("text", i.cast("string")), 256))
    made = F.flatten(F.transform(digests, lambda d: F.array(F.upper(d), F.base64(F.unhex(d)))))  # random by construction
    random = sample.select(F.explode(F.concat(F.expr("transform(spans, x -> x.value)"), made)).alias("string"), F.lit(1).alias("random"))
    plain = sample.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z][A-Za-z_]{7,}"), 0)).alias("string"), F.lit(0).alias("random"))
    counts = random.union(plain).where("char_length(string) > 1").select("random", F.explode(_pairs(F.col("string"))).alias("pair")).groupBy("random", "pair").count().collect()  # at most 2 x 16384 rows
    by = [{}, {}]
    for r in counts:
        by[r["random"]][r["pair"]] = r["count"]
    rows = [[sum(by[k].get(a * 128 + b, 0) for b in range(128)) for a in range(128)] for k in (0, 1)]
    columns = [[sum(by[k].get(a * 128 + b, 0) for a in range(128)) for b in range(128)] for k in (0, 1)]
    # Pairs are smoothed towards how frequent the second character is, and that towards 64 equally likely ones.
    single = [[(n + 0.5) / (sum(c) + 32) for n in c] for c in columns]
    log = lambda k, a, b: math.log((by[k].get(a * 128 + b, 0) + 8 * single[k][b]) / (rows[k][a] + 8))
    if not by[1] or not by[0]:
        return [0.0] * 16384
    return [round(log(1, a, b) - log(0, a, b), 3) for a in range(128) for b in range(128)]


def scan(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """The documents with base_spans, what the rules find, and spans, all spans by start and kind."""
    ratio = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded to a constant
    text = F.coalesce("text", F.lit(""))
    long_string = f"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}"

    def random(string: Column) -> Column:
        whole = F.aggregate(_pairs(string), F.lit(0.0), lambda acc, p: acc + F.get(ratio, p))
        short = F.char_length(string) - 1 < MIN_TOTAL / MIN_RATIO
        return (whole >= F.when(short, MIN_TOTAL).otherwise(MIN_RATIO * (F.char_length(string) - 1))) & (~short | F.regexp_like(string, F.lit("^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+$")))

    docs = docs.drop("base_spans", "spans")
    left, strings = fresh(docs, "left"), fresh(docs, "strings")
    base = docs.withColumn("base_spans", rule_spans(text)).withColumn(left, F.when(F.size("base_spans") > 0, uncovered(text)).otherwise(text))
    base = base.withColumn(strings, found(F.col(left), long_string, "random", len(RULES), 0, MIN_LENGTH))
    secret = F.filter(strings, lambda x: random(x["value"]))
    return base.withColumn("spans", F.array_sort(F.concat("base_spans", secret))).drop(left, strings)


def listed(spans: Column | str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column | str, spans: Column | str, mask: str = MASK) -> Column:
    """The text with every span, overlapping ones together, replaced by the mask."""
    text, spans = F.coalesce(text, F.lit("")), F.col(spans) if isinstance(spans, str) else spans
    nothing = F.array().cast("array<string>")

    def walk(acc: Column, some: Column) -> Column:
        until = F.greatest(acc["at"], F.coalesce(F.array_max(F.transform(some, lambda x: x["end"])), F.lit(0)))

        def step(inner: Column, x: Column) -> Column:
            apart = x["start"] >= inner["at"]
            between = F.substring(inner["text"], inner["at"] - acc["at"] + 1, x["start"] - inner["at"])
            return F.struct(F.greatest(inner["at"], x["end"]).alias("at"), inner["text"].alias("text"), F.when(apart, F.concat(inner["out"], F.array(between, F.lit(mask)))).otherwise(inner["out"]).alias("out"))

        start = F.struct(acc["at"].alias("at"), F.substring(text, acc["at"] + 1, until - acc["at"]).alias("text"), nothing.alias("out"))
        return bound(F.aggregate(some, start, step), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")))

    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    return F.aggregate(groups(spans), start, walk, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))
