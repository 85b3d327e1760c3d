"""Readings of regions: clean-up, engine routes, and the merge of two engines into one reading."""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrine.functions import parsing as P

SCORE = "decimal(9,4)"
GATE = 0.80
DIVERGENCE = 0.30
#: Digits that are compared as one number.
PIECE = 15
# What a second reader is asked for, by region.
PROMPTS = {"rib": ("R05", "R14"), "amount_digits": ("R06", "R10"), "amount_text": ("R09",), "date": ("R02", "R03", "R12", "R13"), "city": ("R04", "R11"), "name": ("R07", "R08", "R15"), "domiciliation": ("R16",)}


def clean(readings: DataFrame, regions: DataFrame) -> DataFrame:
    """First-engine texts rid of the characters that their region doesn't allow."""
    return readings.join(F.broadcast(regions.select("roi_id", "allowed")), "roi_id").withColumn("cleaned", P.whitelist(F.col("text"), F.col("allowed")))


def routed(readings: DataFrame, regions: DataFrame, skip_second: bool = False) -> DataFrame:
    """Adds the engine route; without the second engine all but the barcode go to the first."""
    known = _known_route(F.col("route"))
    route = F.when(known != "barcode_decoder", "tesseract").otherwise(known) if skip_second else known
    return readings.join(F.broadcast(regions.select("roi_id", "route")), "roi_id").withColumn("route", route)


def passes_gate(confidence: Column, error: Column | None = None, gate: float = GATE) -> Column:
    """Sure enough, and read without an error."""
    return (confidence >= gate) & (F.lit(True) if error is None else F.coalesce(error, F.lit("")) == "")


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def texts_agree(a: Column, b: Column) -> Column:
    solid = lambda x: F.regexp_replace(x, f"{P.SPACE}+", "")
    return (F.upper(solid(a)) == F.upper(solid(b))) & (solid(a) != "")


def fill_unread(first: Column, second: Column) -> Column:
    """The second text with the first one's digit wherever it has a question mark at the same place."""
    at = F.locate("?", second)
    there = F.substring(first, at, F.lit(1))
    one = F.when(F.regexp_like(there, F.lit("^[0-9]$")), F.concat(F.substring(second, F.lit(1), at - 1), there, F.substring(second, at + 1, F.length(second)))).otherwise(second)
    several = F.array_join(
        F.transform(F.filter(F.split(second, ""), lambda c: c != ""), lambda c, i: F.when((c == "?") & F.regexp_like(F.substring(first, i + 1, F.lit(1)), F.lit("^[0-9]$")), F.substring(first, i + 1, F.lit(1))).otherwise(c)),
        "",
    )
    return F.when(F.length(F.replace(second, F.lit("?"), F.lit(""))) == F.length(second) - 1, one).otherwise(several)


def digits_changed(first: Column, second: Column) -> Column:
    """Digits that differ place by place, and the difference in number."""
    return P.let(F.struct(digits(first).alias("a"), digits(second).alias("b")), lambda d: _changed(d["a"], d["b"]))


def _changed(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    number = lambda x, at: F.conv(F.substring(x, F.lit(at), F.least(n - (at - 1), F.lit(PIECE))), 16, 10).cast("bigint")
    # Digits of both as hexadecimal numbers: where they differ, their exclusive or has a digit that isn't 0.
    piece = lambda at: F.when(n >= at, F.length(F.replace(F.hex(number(a, at).bitwiseXOR(number(b, at))), F.lit("0"), F.lit("")))).otherwise(0)
    short = piece(1) + piece(1 + PIECE) + piece(1 + 2 * PIECE)
    long = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))
    same_place = F.when((n > 0) & (a != b), F.when(n <= 3 * PIECE, short).otherwise(long)).otherwise(0)
    return same_place + F.abs(F.length(a) - F.length(b))


def diverges(first: Column, second: Column, threshold: float = DIVERGENCE) -> Column:
    total = F.length(digits(first))
    return (total > 0) & (digits_changed(first, second) > threshold * total)


def _known_route(route: Column) -> Column:
    return F.when(route.isin("barcode_decoder", "qwen", "tesseract_then_qwen"), route).otherwise("tesseract")


def _last_readings(sorted_: str) -> Column:
    """Of readings sorted by region, engine and text, a map by region and engine of the last of each."""
    place = lambda r: F.concat_ws(" ", r["roi_id"], r["engine"])
    keyed = F.transform(sorted_, lambda r: F.struct(place(r).alias("place"), F.struct(*[r[n].alias(n) for n in ("text", "confidence", "available", "error")]).alias("r")))
    return P.let(keyed, lambda k: F.map_from_entries(F.filter(k, lambda r, i: ~F.get(k, i + 1)["place"].eqNullSafe(r["place"]))))


def document_sides(sets: DataFrame, regions: DataFrame, *routes: str, whole: bool = False, parts: int = 0) -> DataFrame:
    """doc_id and ``sides``, an array of what ``sides`` gives as rows, of documents that bring an array of readings.

    Arrays of one document are put together, so it is dealt as a row or a few, and not reading by reading.
    With ``whole`` each is one row already, and nothing is dealt. ``parts``: tasks that documents are dealt to, where
    tables that meet them are dealt so too.
    """
    wanted = regions.select("roi_id", _known_route(F.col("route")).alias("route"))
    catalogue = (wanted.where(F.col("route").isin(*routes)) if routes else wanted).agg(F.collect_list(F.struct("roi_id", "route")).alias("regions"))
    some = sets.select("doc_id", "readings")
    dealt = some.repartition(parts, "doc_id") if parts else some.repartition("doc_id")
    one = some if whole else dealt.groupBy("doc_id").agg(F.flatten(F.collect_list("readings")).alias("readings"))
    docs = one.select("doc_id", F.sort_array("readings").alias("all"))
    last = _last_readings("all")
    at = lambda c, engine: F.try_element_at("last", F.concat_ws(" ", c["roi_id"], F.lit(engine)))
    found = F.transform("regions", lambda c: F.struct(c["roi_id"].alias("roi_id"), c["route"].alias("route"), at(c, "tesseract").alias("one"), at(c, "qwen").alias("two"), at(c, "pyzbar").alias("symbol")))
    there = lambda s: s["one"].isNotNull() | s["two"].isNotNull() | s["symbol"].isNotNull()
    return docs.select("doc_id", last.alias("last")).crossJoin(F.broadcast(catalogue)).select("doc_id", F.filter(found, there).alias("sides"))  # readers of this go by an expression over it: of a bare column generators infer a filter, which works the array out again


def sides(readings: DataFrame, regions: DataFrame, *routes: str, whole: bool = False) -> DataFrame:
    """One row a region of a document: its route and the readings ``one``, ``two`` and ``symbol`` of the two engines and the decoder, NULL where there is none.

    With ``routes`` named, readings of other regions are left out where they are read.
    The rest are dealt by document once, which serves what follows by document
    too. Of repeated readings by one engine the last in order counts. Documents may also
    bring an array of their ``readings``, and be ``whole``.
    """
    if "readings" in readings.columns:
        return document_sides(readings, regions, *routes, whole=whole).select("doc_id", F.inline(F.array_compact("sides")))
    known = routed(readings, regions)
    if routes:
        known = known.where(F.col("route").isin(*routes))
    error = F.col("error") if "error" in readings.columns else F.lit(None).cast("string")
    whole = F.struct("text", "confidence", "available", error.alias("error"))
    of = lambda engine: F.max(F.when(F.col("engine") == engine, whole))
    return known.repartition("doc_id").groupBy("doc_id", "roi_id", "route").agg(of("tesseract").alias("one"), of("qwen").alias("two"), of("pyzbar").alias("symbol"))


def pairs(readings: DataFrame, regions: DataFrame, whole: bool = False) -> DataFrame:
    """First and second reading side by side, for the regions that take both."""
    both = sides(readings, regions, "tesseract_then_qwen", whole=whole).where("one is not null")
    return both.select("doc_id", "roi_id", F.col("one.text").alias("first"), F.col("one.confidence").alias("c1"), F.col("two.text").alias("second"), F.col("two.available").alias("available"), F.col("one.error").alias("error"))


def _row(text: Column, score: Column, source: Column | str, flags: Column | None = None, changed: Column | None = None) -> Column:
    none = F.array().cast("array<string>")
    changed = (F.lit(0) if changed is None else F.coalesce(changed, F.lit(0))).cast("int").alias("changed")
    return F.struct(text.alias("text"), score.cast(SCORE).alias("score"), (F.lit(source) if isinstance(source, str) else source).alias("source"), (none if flags is None else F.coalesce(flags, none)).alias("flags"), changed)


def merged_reading(first: Column, c1_: Column, second_: Column, available: Column, error: Column | None = None) -> Column:
    """One reading of two: text, score, source, flags, and how many digits the second reading changes where it was asked for. ``error`` is the first reading's.

    In this order: sure enough and without error, no second reading, question marks filled,
    second reading diverges, both agree, they disagree.
    """
    return _merged_row(first, c1_, second_, available, error, lambda: P.let(F.struct(first.alias("first"), second_.alias("second"), F.length(digits(first)).alias("total"), digits_changed(first, second_).alias("changed")), lambda x: _asked(x, c1_.cast(SCORE))))


def _weight(x: str) -> Column:
    return F.lit(x).cast("decimal(4,2)")


def _asked(x, c1: Column) -> Column:
    """Of both texts, how many digits the first has, and how many differ, and if known the second text with its marks filled; each is worked out once."""
    first, second, changed = x["first"], x["second"], x["changed"]
    total = x["total"]

    def partial(filled: Column) -> Column:
        left = F.length(filled) - F.length(F.replace(filled, F.lit("?"), F.lit("")))
        score = F.greatest(F.lit("0.20").cast(SCORE), (F.lit("0.70").cast(SCORE) - left * F.lit("0.05").cast("decimal(4,2)")).cast(SCORE))
        return _row(filled, score, "merged", F.when(left > 0, F.array(F.format_string("partial_unreadable_%d_chars", left))), changed)

    return (
        F.when(F.contains(second, F.lit("?")), partial(x["filled"]) if isinstance(x, dict) else P.let(_filled(first, second), partial))
        .when((total > 0) & (changed > DIVERGENCE * total), _row(first, c1 * _weight("0.85"), "tesseract", F.array(F.lit("qwen_rejected_divergence")), changed))
        .when(texts_agree(first, second), _row(first, F.least(F.lit(1).cast(SCORE), (_weight("0.70") + _weight("0.30") * c1).cast(SCORE)), "tesseract", None, changed))
        .otherwise(_row(second, F.least(_weight("0.75").cast(SCORE), (_weight("0.27") + _weight("0.30") * c1).cast(SCORE)), "qwen", F.array(F.lit("tess_qwen_disagree")), changed))
    )


def _filled(first: Column, second: Column) -> Column:
    return F.when(first != "", fill_unread(first, second)).otherwise(second)


def _merged_row(first: Column, c1_: Column, second: Column, available: Column, error: Column | None, asked) -> Column:
    c1 = c1_.cast(SCORE)
    return (
        F.when(passes_gate(c1_, error), _row(first, c1, "tesseract"))
        .when(~F.coalesce(available, F.lit(False)), _row(first, c1, "tesseract", F.array(F.lit("qwen_unavailable"))))
        .otherwise(asked())
    )


def _merged_columns(df: DataFrame, sides: dict[str, dict[str, Column]]) -> tuple[DataFrame, dict[str, Column]]:
    """``merged_reading`` of first, c1, second, available and error by name, in projections: the rows with further columns, and the readings over these."""
    on = {n: ~F.coalesce(passes_gate(s["c1"], s["error"]), F.lit(False)) & F.coalesce(s["available"], F.lit(False)) for n, s in sides.items()}
    df = df.select("*", *[P.apart(F.when(on[n], digits(s[side])), s["first"]).alias(f"{n}_{side}_digits_") for n, s in sides.items() for side in ("first", "second")])
    of = lambda n, part: F.col(f"{n}_{part}_")
    df = df.select("*", *[P.apart(F.when(on[n], v), s["first"]).alias(f"{n}_{part}_") for n, s in sides.items() for part, v in (("changed", _changed(of(n, "first_digits"), of(n, "second_digits"))), ("total", F.length(of(n, "first_digits"))), ("filled", F.when(F.contains(s["second"], F.lit("?")), _filled(s["first"], s["second"]))))])
    return df, {n: _merged_row(s["first"], s["c1"], s["second"], s["available"], s["error"], lambda n=n, s=s: _asked({"first": s["first"], "second": s["second"], **{part: of(n, part) for part in ("total", "changed", "filled")}}, s["c1"].cast(SCORE))) for n, s in sides.items()}


def _side(columns: DataFrame, roi: str, engine: str) -> dict[str, Column] | None:
    """A reading of ``columns``, if they have it."""
    names = ("text", "confidence", "available", "error", "there")
    return {n: F.col(f"{roi}_{engine}_{n}") for n in names} if f"{roi}_{engine}_there" in columns.columns else None


def column_sides(columns: DataFrame, routes: dict[str, str]) -> dict[str, dict]:
    """Of readings that are columns: by region the readings ``one``, ``two`` and ``symbol`` of the engines, with no columns of those that are missing."""
    none = {"text": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double"), "available": F.lit(None).cast("boolean"), "error": F.lit(None).cast("string"), "there": F.lit(False)}
    found = {r: {n: _side(columns, r, e) for n, e in (("one", "tesseract"), ("two", "qwen"), ("symbol", "pyzbar"))} for r in routes}
    return {r: {n: s or none for n, s in sides_.items()} for r, sides_ in found.items() if any(sides_.values())}


def set_columns(sets: DataFrame, routes: dict[str, str], parts: int, beside: tuple = ()) -> DataFrame:
    """Readings as columns, as ``resolved_columns`` takes them, of documents that bring arrays of readings; those without any that count are left out.

    Arrays of one document are put together by ``parts`` tasks, and columns of the tables ``beside`` (by doc_id, or of one row for all) joined before anything is made of them.
    """
    engines = {"tesseract_then_qwen": ("tesseract", "qwen"), "qwen": ("qwen",), "barcode_decoder": ("tesseract", "pyzbar")}
    names = [(r, e) for r, route in routes.items() for e in engines.get(route, ("tesseract",))]
    count = F.array(*[F.lit(f"{r} {e}") for r, e in names if not (routes[r] == "tesseract_then_qwen" and e == "qwen")])
    one = sets.select("doc_id", "readings").repartition(parts, "doc_id").groupBy("doc_id").agg(F.flatten(F.collect_list("readings")).alias("readings"))
    some = F.filter(F.array(_last_readings("all")), lambda m: F.arrays_overlap(F.map_keys(m), count))
    docs = one.select("doc_id", F.sort_array("readings").alias("all")).select("doc_id", F.explode(some).alias("last"))
    for table in beside:
        docs = docs.join(table, "doc_id", "left") if "doc_id" in table.columns else docs.crossJoin(F.broadcast(table))
    kept = [c for c in docs.columns if c != "last"]
    cells = docs.select(*kept, *[P.apart(F.try_element_at("last", F.lit(f"{r} {e}")), F.col("doc_id")).alias(f"{r}_{e}") for r, e in names])
    return cells.select(*kept, *[c.alias(f"{r}_{e}_{n}") for r, e in names for n, c in (*[(n, F.col(f"{r}_{e}")[n]) for n in ("text", "confidence", "available", "error")], ("there", F.col(f"{r}_{e}").isNotNull()))])


def resolved_columns(columns: DataFrame, routes: dict[str, str], sure: bool = False) -> DataFrame:
    """What ``resolved`` gives as rows as a column a region, by its name, NULL where there is none; one row a document, none for documents without any.

    Takes readings as columns ``<region>_<engine>_<part>``, as ``fixtures.reading_columns`` does, and the engine route of each region. Other columns stay. ``sure``: every document has a reading that counts.
    """
    found = column_sides(columns, routes)
    of = {r: routes[r] if routes[r] in ("barcode_decoder", "qwen", "tesseract_then_qwen") else "tesseract" for r in found}
    there = {r: {"tesseract_then_qwen": s["one"]["there"], "tesseract": s["one"]["there"], "qwen": s["two"]["there"], "barcode_decoder": s["one"]["there"] | s["symbol"]["there"]}[of[r]] for r, s in found.items()}
    kept = [c for c in columns.columns if not re.fullmatch("R[0-9]{2}_(tesseract|qwen|pyzbar)_(text|confidence|available|error|there)", c)]
    docs = columns if sure else columns.where(functools.reduce(operator.or_, there.values()))
    pairs_ = {r: {"first": s["one"]["text"], "c1": s["one"]["confidence"], "error": s["one"]["error"], "second": F.when(s["two"]["there"], s["two"]["text"]), "available": F.when(s["two"]["there"], s["two"]["available"])} for r, s in found.items() if of[r] == "tesseract_then_qwen"}
    docs, merged_ = _merged_columns(docs, pairs_) if pairs_ else (docs, {})

    def row(r: str) -> Column:
        s = {n: {p: c if p == "there" else F.when(x["there"], c) for p, c in x.items()} for n, x in found[r].items()}
        return merged_[r] if r in merged_ else barcode_row(s["one"], s["symbol"]) if of[r] == "barcode_decoder" else second_row(s["two"]) if of[r] == "qwen" else first_row(s["one"])

    return docs.select(*kept, *[P.apart(F.when(there[r], row(r)), F.col("doc_id")).alias(r) for r in found])


def column_pairs(columns: DataFrame, routes: dict[str, str]) -> DataFrame:
    """``pairs`` of readings that are columns."""
    found = {r: s for r, s in column_sides(columns, routes).items() if routes[r] == "tesseract_then_qwen"}
    row = lambda r, s: F.struct(F.lit(r).alias("roi_id"), s["one"]["text"].alias("first"), s["one"]["confidence"].alias("c1"), F.when(s["two"]["there"], s["two"]["text"]).alias("second"), F.when(s["two"]["there"], s["two"]["available"]).alias("available"), s["one"]["error"].alias("error"))
    kind = "array<struct<roi_id:string,first:string,c1:double,second:string,available:boolean,error:string>>"
    return columns.select("doc_id", F.inline(F.concat(*[F.when(s["one"]["there"], F.array(row(r, s)).cast(kind)).otherwise(F.array().cast(kind)) for r, s in found.items()])))


def merged(side_by_side: DataFrame) -> DataFrame:
    """The merged readings of pairs, with the digits that the second reading changes and the first one's."""
    c = F.col
    sides_ = {n: c(n) for n in ("first", "c1", "second", "available")} | {"error": c("error") if "error" in side_by_side.columns else F.lit(None).cast("string")}
    rows, found = _merged_columns(side_by_side, {"pair": sides_})
    both = rows.select("doc_id", "roi_id", P.apart(found["pair"], c("first")).alias("m"), P.apart(digits(c("first")), c("first")).alias("a"), P.apart(digits(F.coalesce("second", F.lit(""))), c("first")).alias("b"))
    return both.select("doc_id", "roi_id", "m.text", "m.score", "m.source", "m.flags", _changed(c("a"), c("b")).alias("changed"), F.length("a").alias("total"))


def single_reading(route: Column, one: Column, two: Column) -> Column:
    """Of ``sides``: the reading of a region that takes one engine, NULL for others."""
    return F.when((route == "tesseract") & one.isNotNull(), first_row(one)).when((route == "qwen") & two.isNotNull(), second_row(two))


def first_row(one) -> Column:
    return _row(one["text"], one["confidence"], "tesseract", F.when(~one["available"], F.array(F.lit("tesseract_unavailable"))))


def second_row(two) -> Column:
    there = F.coalesce(two["available"], F.lit(False))
    return _row(F.when(there, two["text"]).otherwise(""), F.when(there, F.lit("0.70")).otherwise("0"), F.when(there, "qwen").otherwise("none"), F.when(~there, F.array(F.lit("qwen_unavailable"))))


def barcode_reading(route: Column, one: Column, symbol: Column) -> Column:
    """Of ``sides``: the decoded text with full score, else the digits of the read text with its own, else nothing."""
    return F.when((route == "barcode_decoder") & (one.isNotNull() | symbol.isNotNull()), barcode_row(one, symbol))


def barcode_row(one, symbol) -> Column:
    decoded, read = F.coalesce(symbol["text"], F.lit("")), F.coalesce(digits(one["text"]), F.lit(""))
    score = F.when(decoded != "", F.lit(1.0)).when(read != "", one["confidence"]).otherwise(0.0)
    source = F.when(decoded != "", "barcode_pyzbar").when(read != "", "barcode_tesseract_ocrb").otherwise("barcode_none")
    return _row(F.when(decoded != "", decoded).otherwise(read), score, source, F.when((decoded == "") & (read == ""), F.array(F.lit("barcode_unreadable"))))


def _flat(rows: DataFrame, reading: Column) -> DataFrame:
    """One row where the reading isn't NULL; a generator, so that it is worked out once."""
    return rows.select("doc_id", "roi_id", F.inline(F.array_compact(F.array(reading))))


def singles(readings: DataFrame, regions: DataFrame, whole: bool = False) -> DataFrame:
    return _flat(sides(readings, regions, "tesseract", "qwen", whole=whole), single_reading(F.col("route"), F.col("one"), F.col("two")))


def barcodes(readings: DataFrame, regions: DataFrame, whole: bool = False) -> DataFrame:
    return _flat(sides(readings, regions, "barcode_decoder", whole=whole), barcode_reading(F.col("route"), F.col("one"), F.col("symbol")))


def _resolved(route: Column, one: Column, two: Column, symbol: Column) -> Column:
    pair = F.when((route == "tesseract_then_qwen") & one.isNotNull(), merged_reading(one["text"], one["confidence"], two["text"], two["available"], one["error"]))
    return F.when(route == "tesseract_then_qwen", pair).when(route == "barcode_decoder", barcode_reading(route, one, symbol)).otherwise(single_reading(route, one, two))


def resolved(readings: DataFrame, regions: DataFrame, whole: bool = False) -> DataFrame:
    """One reading for each region of a document: doc_id, roi_id, text, score, source, flags, changed. Readings are read and dealt once."""
    if "readings" in readings.columns:
        return resolved_documents(readings, regions, whole).select("doc_id", F.inline(F.array_compact("cells")))
    return _flat(sides(readings, regions), _resolved(F.col("route"), F.col("one"), F.col("two"), F.col("symbol")))


def resolved_documents(sets: DataFrame, regions: DataFrame, whole: bool = False, parts: int = 0) -> DataFrame:
    """doc_id and ``cells``, an array of what ``resolved`` gives as rows, of documents that bring an array of readings; those without any are left out."""
    row = lambda s: P.let(_resolved(s["route"], s["one"], s["two"], s["symbol"]), lambda m: F.when(m.isNotNull(), F.struct(s["roi_id"].alias("roi_id"), *[m[n].alias(n) for n in ("text", "score", "source", "flags", "changed")])))
    cells = P.let(F.array_compact(F.transform("sides", row)), lambda c: F.filter(F.array(c), lambda x: F.size(x) > 0))
    return document_sides(sets, regions, whole=whole, parts=parts).select("doc_id", F.explode(cells).alias("cells"))  # a generator, so that they are worked out once


def worklist(readings: DataFrame, regions: DataFrame, whole: bool = False) -> DataFrame:
    """Readings that still need a second one: under the gate, and without an available second reading."""
    return pairs(readings, regions, whole).where(~passes_gate(F.col("c1"), F.col("error")) & ~F.coalesce("available", F.lit(False))).select("doc_id", "roi_id", F.col("c1").alias("confidence"))


def prompt(roi_id: Column) -> Column:
    kind = F.lit("generic")
    for name, ids in PROMPTS.items():
        kind = F.when(roi_id.isin(*ids), name).otherwise(kind)
    return kind


def best_variant(variants: DataFrame, regions: DataFrame) -> DataFrame:
    """Fewest question marks, then in fields of digits or amounts the most digits, then the earliest; the original if all are empty."""
    variants = variants.join(F.broadcast(regions.select("roi_id", "allowed")), "roi_id")
    text = F.col("text")
    many = F.when(F.col("allowed") != "any", -F.length(digits(text))).otherwise(0)
    marks = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    rank = F.struct(marks.alias("q"), many.alias("d"), "variant")
    return variants.groupBy("doc_id", "roi_id").agg(F.min_by(F.struct("variant", "text"), rank).alias("b"), F.max(text != "").alias("any"), F.min_by("text", "variant").alias("original")).select("doc_id", "roi_id", F.when(F.col("any"), F.col("b.text")).otherwise(F.col("original")).alias("text"), F.when(F.col("any"), F.col("b.variant")).otherwise(0).alias("variant"))


def word_boxes(words: DataFrame, fields: DataFrame) -> DataFrame:
    """Words to one reading: in order, without blank ones and boxes of no word; the mean of the scores, 0 where none is left."""
    kept = words.where((F.trim("word") != "") & (F.col("conf") >= 0))
    joined = kept.groupBy("doc_id", "roi_id").agg(F.array_sort(F.collect_list(F.struct("seq", F.trim("word").alias("word")))).alias("w"), F.avg("conf").alias("c"))
    return fields.join(joined, ["doc_id", "roi_id"], "left").select("doc_id", "roi_id", F.coalesce(F.array_join(F.transform("w", lambda x: x["word"]), " "), F.lit("")).alias("text"), F.coalesce(F.col("c") / 100, F.lit(0.0)).alias("confidence"))


def unpack_responses(responses: DataFrame) -> DataFrame:
    """Model responses: envelope, code fence, inner object; whatever of these is broken is taken as text."""
    content = F.get_json_object("raw", "$.choices[0].message.content")
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.trim(content), r"```(json)?\s*", ""), "`+$", ""))
    inner = F.get_json_object(plain, "$.text")
    is_object = F.regexp_like(plain, F.lit(r"^\{")) & F.get_json_object(plain, "$").isNotNull()
    text = F.when(content.isNull(), F.col("raw")).when(is_object, F.trim(F.coalesce(inner, F.lit("")))).otherwise(plain)
    return responses.select("doc_id", "roi_id", text.alias("text"), F.coalesce(F.when(is_object, F.get_json_object(plain, "$.readable").cast("boolean")), F.lit(True)).alias("readable"))
