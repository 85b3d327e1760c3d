"""Field standardisers as Column expressions: each turns a text column into a struct, NULL text into NULL."""

from __future__ import annotations

import json
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of Unicode, as readers and people type it: no-break spaces part thousands.
#: The first class tells most characters apart at once; the second is tried range by range.
SPACE = r"[[\x00-\x20\x7F-\u3000]&&[ \t\n\x0B\f\r\x1C-\x1F\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]]"
#: The same as characters.
SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
AMOUNT = "decimal(21,3)"

# Characters that readers confuse, and what they stand for.
DIGIT_LIKE, DIGITS = "OolI|SsBGZ", "0011155862"
DATE_LIKE, DATE_DIGITS = "OolI", "0011"
PART_LIKE, PART_DIGITS = "OolISZBG", "00115286"
# Accents that the words of numbers are read without.
ACCENTED, PLAIN = "éèêàâôûî", "eeeaaoui"
YEARS = (2000, 2035)
# Words of a company's legal form.
LEGAL_FORMS = r"SARL SA SUARL STE SNC SC SEP GIE ETS CIE LLC SPA NIF MF SOCIETE ENTREPRISE GROUPE CORP CO\. COMPANY".split()


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it.

    It is the start of a fold over nothing: unlike the element of an array, neither value nor result is copied.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, use)


def apart(value: Column, column: Column) -> Column:
    """The value, in a projection that whole-stage code leaves alone.

    The JVM compiles no method of more than 8 KB. A projection by itself is generated as many small methods; in
    a whole stage all of it is one. Stages take in no lambda, and this one is only run where the value is NULL.
    """
    return F.coalesce(value, let(column, lambda _: F.lit(None)))


def digit_confusion(text: Column) -> Column:
    return F.translate(text, DIGIT_LIKE, DIGITS)


def date_confusion(text: Column) -> Column:
    return F.translate(text, DATE_LIKE, DATE_DIGITS)


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def whitelist(text: Column, allowed: Column) -> Column:
    """Collapsed, and for fields of digits or amounts rid of other characters."""
    plain = collapse_spaces(text)
    fixed = digit_confusion(plain)
    return F.when(allowed == "amount", F.regexp_replace(fixed, "[^0-9,.]", "")).when(allowed == "digits", F.regexp_replace(fixed, "[^0-9]", "")).otherwise(plain)


def rib(text: Column) -> Column:
    """Account numbers: 2 + 3 + 13 + 2 digits; ``?`` stands for an unreadable one and keeps the parts but not the validity."""
    return composed(text, RIB)


def _rib_parts(digits: Column) -> Column:
    whole, unread = F.length(digits) == 20, F.contains(digits, F.lit("?"))
    kept = F.when(whole, digits)
    part = lambda i, n: F.substring(kept, i, n)
    valid = whole & ~unread & F.coalesce(rib_key(F.substring(digits, 1, 18)) == F.substring(digits, 19, 2).try_cast("int"), F.lit(False))
    error = F.when(~whole, "length").when(unread, "unreadable").when(~valid, "key")
    return F.struct(kept.alias("digits"), part(1, 2).alias("bank_code"), part(3, 3).alias("branch_code"), part(6, 13).alias("account"), part(19, 2).alias("key"), unread.alias("unread"), valid.alias("valid"), error.alias("error"))


def rib_key(number: Column) -> Column:
    """Check key of 18 digits: 97 - (N * 100 mod 97), 0 for 97; the remainder first, so that nothing overflows."""
    return (97 - (number.try_cast("bigint") % 97 * 100) % 97) % 97


def date(text: Column) -> Column:
    """Three parts, day or year first; years of two digits are of this century."""
    return composed(text, DATE)


def _date_parts(x) -> dict[str, Column]:
    """What stands between separators, with the first and last of them gone."""
    between = rf"(?:{SPACE}|[/.-])+"
    apart_ = F.regexp_replace(F.translate(x["text"], PART_LIKE, PART_DIGITS), between, "/")
    return {"parts": F.split(F.btrim(apart_, F.lit("/")), "/")}  # split at one character: a pattern would be compiled for each row


def _date_numbers(x) -> dict[str, Column]:
    parts = x["parts"]
    at = [F.get(parts, F.lit(i)) for i in range(3)]
    digits = (F.size(parts) == 3) & F.regexp_like(F.concat(*at), F.lit("^[0-9]+$")) & (at[0] != "") & (at[1] != "") & (at[2] != "")
    return {"n": F.size(parts), "digits": F.coalesce(digits, F.lit(False)), "four": F.length(at[0]) == 4, **{n: p.try_cast("int") for n, p in zip(("one", "two", "three"), at)}}


def _date_places(x) -> dict[str, Column]:
    iso = x["four"] | (x["one"] > 1000)
    year = F.when(iso, x["one"]).otherwise(x["three"])
    return {"year": F.when(year < 100, year + 2000).otherwise(year), "month": x["two"], "day": F.when(iso, x["three"]).otherwise(x["one"])}


def _date_value(d) -> dict[str, Column]:
    good = lambda x, low, high: F.coalesce(x.between(low, high), F.lit(False))
    months, days, years = good(d["month"], 1, 12), good(d["day"], 1, 31), good(d["year"], *YEARS)
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    value = F.when(d["digits"] & months & days & years, F.concat_ws("-", d["year"].cast("string"), pad(d["month"]), pad(d["day"])).try_cast("date"))
    error = F.when(d["n"] != 3, "parts").when(~d["digits"], "digits").when(~months, "month").when(~days, "day").when(~years, "year").otherwise("calendar")
    return {"value": value, "problem": error}


def _date_row(d) -> Column:
    v = d["value"]
    return F.struct(v.alias("value"), F.date_format(v, "dd/MM/yyyy").alias("normalised"), v.isNotNull().alias("valid"), F.when(v.isNull(), d["problem"]).alias("error"))


def clean_amount(text: Column) -> Column:
    return stripped(F.regexp_replace(F.regexp_replace(stripped(text), "#", ""), r"(?iU)\b(DT|TND)\b", ""))


def resolve_separators(text: Column) -> Column:
    """The last separator before exactly three final digits is the decimal point; all others part thousands. NULL if nothing is left."""
    return let(F.replace(text, F.lit(" ")), _separated)


def _separated(compact: Column) -> Column:
    split = rf"(?s)^(.*)[.,]([0-9]{{3}}){SPACE}*$"
    marks = rf"[.,]|{SPACE}"
    whole = F.regexp_replace(F.regexp_extract(compact, split, 1), marks, "")
    decimal = F.concat(whole, F.lit("."), F.regexp_extract(compact, split, 2))
    return F.when(F.regexp_like(compact, F.lit(split)), decimal).otherwise(F.nullif(F.regexp_replace(compact, marks, ""), F.lit("")))


def amount(text: Column) -> Column:
    """A decimal of three places; ``?`` stands for an unreadable digit and keeps the text but not the validity."""
    return composed(text, AMOUNT_STEPS)


def _amount_number(x) -> dict[str, Column]:
    n = x["normal"]
    return {"number": F.when(F.regexp_like(n, F.lit(r"^[+-]?([0-9]+(\.[0-9]{3})?|\.[0-9]{3})$")), n).try_cast(AMOUNT), "unread": F.contains(x["text"], F.lit("?"))}


def _amount_value(r) -> Column:
    good = ~r["unread"] & F.coalesce(r["number"] >= 0, F.lit(False))
    error = F.when(r["normal"].isNull(), "empty").when(r["unread"], "unreadable").when(r["number"].isNull(), "number").when(~good, "negative")
    value = F.when(good, r["number"])
    return F.struct(value.alias("value"), F.when(r["unread"], r["normal"]).when(good, value.cast("string")).alias("normalised"), r["unread"].alias("unread"), good.alias("valid"), error.alias("error"))


def _lexicon() -> dict[str, int]:
    """Words of numbers by rule; cent, mille and million are marked by negative values."""
    units = dict(zip("zero un deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize".split(), range(17))) | {"une": 1, "dix-sept": 17, "dix-huit": 18, "dix-neuf": 19}
    tens = {"vingt": 20, "trente": 30, "quarante": 40, "cinquante": 50, "soixante": 60}
    words = dict(units) | tens
    for (ten, t), (unit, u) in product(tens.items(), units.items()):
        if 2 <= u <= 9:
            words[f"{ten}-{unit}"] = t + u
        elif unit == "un":
            words[f"{ten}-et-un"] = t + 1
    for unit, u in units.items():
        if 12 <= u <= 19:
            words[f"soixante-{unit}"] = 60 + u
        if 1 <= u <= 16 and unit != "une":
            words[f"quatre-vingt-{unit}"] = 80 + u
    words |= {"vingt-et-une": 21, "soixante-et-onze": 71, "soixante-dix": 70, "quatre-vingt": 80, "nonante": 90}
    return words | {w: -100 for w in ("cent", "cents")} | {w: -1000 for w in ("mille", "milles")} | {w: -1000000 for w in ("million", "millions")}


# Fixed values, spelled by the rules above: what each word counts.
LEXICON = _lexicon()
# Words that carry no number, and the units of currency.
NOISE = "et de le la les des du au aux virgule point".split()
DINARS = "dinar dinars dt tnd".split()
MILLIMES = "millime millimes m".split()
#: Pairs that are one word when written apart.
APART = r"(^| )(soixante)  (dix)( |$)|(^| )(dix)  (sept|huit|neuf)( |$)|(^| )(quatre)  (vingt)( |$)"


def tokens(text: Column) -> Column:
    """Lower-case words without accents; hyphens stay inside words."""
    folded = F.translate(F.lower(text), ACCENTED, PLAIN)
    return F.filter(F.split(F.regexp_replace(folded, rf"(?:{SPACE}|[,;])+", " "), " "), lambda t: t != "")  # split at one character: a pattern would be compiled for each row


def words_to_int(words: Column) -> Column:
    """The number that an array of words spells: NULL if it is empty or holds an unknown word."""
    joined = F.array_join(words, "  ")
    joined = F.trim(F.regexp_replace(joined, APART, "$1$5$9$2$6$10-$3$7$11$4$8$12"))
    parts = F.filter(F.split(joined, " "), lambda t: ~t.isin(*NOISE) & (t != ""))
    lexicon = F.from_json(F.lit(json.dumps(LEXICON)), "map<string,int>")  # a constant
    codes = F.transform(parts, lambda t: F.try_element_at(lexicon, t))
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("now"), F.lit(True).alias("known"))

    def step(acc: Column, code: Column) -> Column:
        at_least_one = F.greatest(acc["now"], F.lit(1).cast("bigint"))
        big = code <= -1000
        total = F.when(big, acc["total"] - at_least_one * code).otherwise(acc["total"])
        now = F.when(big, F.lit(0).cast("bigint")).when(code == -100, at_least_one * 100).otherwise(acc["now"] + F.coalesce(code, F.lit(0)))
        return F.struct(total.alias("total"), now.alias("now"), (acc["known"] & code.isNotNull()).alias("known"))

    return F.when(F.size(words) > 0, F.aggregate(codes, start, step, lambda acc: F.when(acc["known"], acc["total"] + acc["now"])))


def amount_words(text: Column) -> Column:
    """Dinars before the first unit of currency, millimes after it; millimes that can't be read count as none."""
    return F.when(text.isNotNull(), let(let(tokens(text), _word_parts), _word_value))


def _word_parts(found: Column) -> Column:
    is_unit = lambda t: t.isin(*DINARS, *MILLIMES)
    first = F.array_position(F.transform(found, is_unit), F.lit(True)).cast("int")

    def parts(at: Column) -> Column:
        before = F.slice(found, F.lit(1), at - 1)
        after = F.filter(F.slice(found, at, F.size(found) - at + 1), lambda t: ~is_unit(t))
        return F.struct(F.size(found).alias("n"), words_to_int(before).alias("dinars"), F.coalesce(words_to_int(after), F.lit(0).cast("bigint")).alias("millimes"))

    return let(F.when(first == 0, F.size(found) + 1).otherwise(first), parts)


def _word_value(w: Column) -> Column:
    good = w["dinars"].isNotNull() & (w["millimes"] <= 999)
    value = F.when(good, (w["dinars"].cast(AMOUNT) + (w["millimes"].cast(AMOUNT) / 1000).cast(AMOUNT)).cast(AMOUNT))
    error = F.when(w["n"] == 0, "empty").when(w["dinars"].isNull(), "dinars").when(~good, "millimes")
    return F.struct(value.alias("value"), good.alias("valid"), error.alias("error"))


def name(text: Column) -> Column:
    return composed(text, NAME)


def _name_value(x) -> dict[str, Column]:
    return {"value": F.upper(collapse_spaces(F.regexp_replace(F.regexp_replace(x["text"], r"(?i)\[STAMP\]", " "), r"[|\\]+", " ")))}


def _name_row(x) -> Column:
    v = x["value"]
    company = F.regexp_like(v, F.lit(rf"(?U)\b({'|'.join(LEGAL_FORMS)})\b"))
    return F.struct(F.when(v != "", v).alias("value"), company.alias("company"), F.regexp_like(x["text"], F.lit(r"(?i)\[STAMP\]")).alias("occluded"), (v != "").alias("valid"))


def names_match(a: Column, b: Column, threshold: float = 0.8) -> Column:
    """Share of common words among all words of two valid name values."""
    words = lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit(r"(?U)\w+"), 0))
    one, two = words(a), words(b)
    shared, all_ = F.size(F.array_intersect(one, two)), F.size(F.array_union(one, two))
    return F.coalesce(F.when(all_ == 0, True).otherwise(shared >= threshold * all_), F.lit(False))


def dates_equal(a: Column, b: Column) -> Column:
    return F.coalesce(a["value"] == b["value"], F.lit(False))


def date_after(a: Column, b: Column) -> Column:
    return F.coalesce(a["value"] > b["value"], F.lit(False))


def date_on_or_after(a: Column, b: Column) -> Column:
    return F.coalesce(a["value"] >= b["value"], F.lit(False))


def amounts_equal(a: Column, b: Column, tolerance: str = "0.001") -> Column:
    return F.coalesce(F.abs(a["value"] - b["value"]) <= F.lit(tolerance).cast(AMOUNT), F.lit(False))


# A parser as steps: each names values of the text and of earlier steps' values; the last gives the row.
RIB = (lambda x: {"kept": F.regexp_replace(x["text"], "[^0-9?]+", "")}, lambda x: _rib_parts(x["kept"]))
DATE = (_date_parts, _date_numbers, _date_places, _date_value, _date_row)
AMOUNT_STEPS = (lambda x: {"compact": F.replace(clean_amount(x["text"]), F.lit(" "))}, lambda x: {"normal": _separated(x["compact"])}, _amount_number, _amount_value)
NAME = (_name_value, _name_row)
WORDS = (lambda x: amount_words(x["text"]),)


def composed(text: Column, steps) -> Column:
    """The steps as one expression."""

    def after(x, rest) -> Column:
        found = rest[0](x)
        if len(rest) == 1:
            return found
        values = {**x, **found}
        return let(F.struct(*[v.alias(n) for n, v in values.items()]), lambda s: after({n: s[n] for n in values}, rest[1:]))

    return F.when(text.isNotNull(), after({"text": text}, steps))


def parsed(documents: DataFrame, fields: dict) -> DataFrame:
    """Adds a row for each field, of its steps and text column. Each step of all fields is a projection, so that values are worked out once and by compiled code."""
    known = {name: {"text": F.col(text)} for name, (_, text) in fields.items()}
    docs = documents
    for i in range(max(len(steps) for steps, _ in fields.values())):
        new = []
        for name, (steps, text) in fields.items():
            if i < len(steps) - 1:
                for j, (n, value) in enumerate(steps[i](known[name]).items()):
                    new.append((value if j else apart(value, F.col(text))).alias(f"{name}_{n}_"))
                    known[name][n] = F.col(f"{name}_{n}_")
            elif i == len(steps) - 1:
                new.append(apart(F.when(F.col(text).isNotNull(), steps[i](known[name])), F.col(text)).alias(name))
        docs = docs.select("*", *new)
    return docs.select(*documents.columns, *fields)
