"""The engine's intermediate tables in DuckDB's SQL, for the queries that results are held against."""

from __future__ import annotations

from lettrine.functions import parsing as P
from lettrine.sources import catalogues, fixtures

ROIS = catalogues.ROI_IDS


def _values(rows: list[tuple]) -> str:
    show = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(show(x).replace("''", "''") for x in r) + ")" for r in rows)


def readings(condition: str = "true") -> str:
    """The derived tables, with the readings that the condition chooses."""
    return fixtures.ctes(condition) + _CATALOGUES


_CATALOGUES = f"""
, region(roi_id, name, tier, x, y, w, h, padding, route, allowed) AS (VALUES {_values(catalogues.REGIONS)})
, bank(code, bank_name) AS (VALUES {_values(catalogues.BANKS)})
, first_r AS (SELECT doc_id, roi_id, text, CAST(confidence AS DECIMAL(9,4)) AS score, error FROM readings WHERE engine = 'tesseract')
"""
READINGS = readings()

#: White space in texts, each character named; DuckDB's own patterns know ASCII alone.
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def spaced(t: str) -> str:
    """With a plain space for each."""
    return f"translate({t}, '{WHITE}', '{' ' * len(WHITE)}')"


def collapsed(t: str) -> str:
    return f"trim(regexp_replace({spaced(t)}, ' +', ' ', 'g'))"


def solid(t: str) -> str:
    return f"replace({spaced(t)}, ' ', '')"


def cleaned(t: str) -> str:
    return f"trim(regexp_replace(replace(trim({t}, '{WHITE}'), '#', ''), '(?i)\\b(DT|TND)\\b', '', 'g'), '{WHITE}')"


def wide(of: str) -> str:
    cells = ", ".join(f"max(CASE WHEN roi_id = '{r}' THEN text END) AS t{r[1:]}, max(CASE WHEN roi_id = '{r}' THEN score END) AS c{r[1:]}" for r in ROIS)
    return f"SELECT doc_id, {cells} FROM {of} GROUP BY doc_id"


def rib_digits(t: str) -> str:
    return f"regexp_replace({t}, '[^0-9?]', '', 'g')"


def rib_valid(x: str) -> str:
    """Of the digits."""
    n = f"TRY_CAST(substr({x}, 1, 18) AS BIGINT)"
    return f"coalesce(length({x}) = 20 AND NOT contains({x}, '?') AND (97 - ({n} % 97 * 100) % 97) % 97 = TRY_CAST(substr({x}, 19, 2) AS INT), false)"


def date_parts(t: str) -> str:
    return f"list_transform(list_filter(regexp_split_to_array({spaced(t)}, '[ /.-]+'), lambda p: p <> ''), lambda p: translate(p, '{P.PART_LIKE}', '{P.PART_DIGITS}'))"


def date_value(p: str) -> str:
    """Of the parts."""
    one, two, three = (f"TRY_CAST({p}[{i}] AS INT)" for i in (1, 2, 3))
    iso = f"(length({p}[1]) = 4 OR {one} > 1000)"
    year = f"(CASE WHEN {iso} THEN {one} ELSE {three} END)"
    year = f"(CASE WHEN {year} < 100 THEN {year} + 2000 ELSE {year} END)"
    day = f"(CASE WHEN {iso} THEN {three} ELSE {one} END)"
    digits = f"len({p}) = 3 AND len(list_filter({p}, lambda q: NOT regexp_matches(q, '^[0-9]+$'))) = 0"
    pad = lambda x: f"lpad(CAST({x} AS VARCHAR), 2, '0')"
    return f"(CASE WHEN {digits} AND {two} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND 31 AND {year} BETWEEN {P.YEARS[0]} AND {P.YEARS[1]} THEN TRY_CAST(concat(CAST({year} AS VARCHAR), '-', {pad(two)}, '-', {pad(day)}) AS DATE) END)"


def date_text(d: str) -> str:
    return f"strftime({d}, '%d/%m/%Y')"


def amount_normal(t: str) -> str:
    compact = solid(cleaned(t))
    split = "^(.*)[.,]([0-9]{3})$"
    return f"nullif(CASE WHEN regexp_matches({compact}, '{split}') THEN concat(regexp_replace(regexp_extract({compact}, '{split}', 1), '[.,]', '', 'g'), '.', regexp_extract({compact}, '{split}', 2)) ELSE regexp_replace({compact}, '[.,]', '', 'g') END, '')"


def amount_value(t: str, normal: str) -> str:
    good = f"NOT contains({t}, '?') AND regexp_matches({normal}, '^[+-]?([0-9]+(\\.[0-9]{{3}})?|\\.[0-9]{{3}})$')"
    return f"(CASE WHEN {good} AND TRY_CAST({normal} AS DECIMAL(21,3)) >= 0 THEN TRY_CAST({normal} AS DECIMAL(21,3)) END)"


def tokens(t: str) -> str:
    return f"list_filter(regexp_split_to_array(translate(lower({spaced(t)}), '{P.ACCENTED}', '{P.PLAIN}'), '[ ,;]+'), lambda t: t <> '')"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" if isinstance(w, str) else str(w) for w in words) + "]"


UNITS_OF_CURRENCY = _list([*P.DINARS, *P.MILLIMES])


def words_to_int(words: str) -> str:
    # RE2 takes one digit after a backslash, so the pairs are joined one after another.
    joined = f"array_to_string({words}, '  ')"
    joined = f"regexp_replace({joined}, '(^| )soixante  dix( |$)', '\\1soixante-dix\\2', 'g')"
    joined = f"regexp_replace({joined}, '(^| )dix  (sept|huit|neuf)( |$)', '\\1dix-\\2\\3', 'g')"
    joined = f"regexp_replace({joined}, '(^| )quatre  vingt( |$)', '\\1quatre-vingt\\2', 'g')"
    parts = f"list_filter(regexp_split_to_array(trim({joined}), ' +'), lambda t: t <> '' AND NOT list_contains({_list(P.NOISE)}, t))"
    codes = f"list_transform({parts}, lambda t: {_list(P.LEXICON.values())}[list_position({_list(P.LEXICON)}, t)])"
    start = "{'total': CAST(0 AS BIGINT), 'now': CAST(0 AS BIGINT), 'code': CAST(0 AS BIGINT), 'known': true}"
    rows = f"list_transform({codes}, lambda c: {{'total': CAST(0 AS BIGINT), 'now': CAST(0 AS BIGINT), 'code': CAST(c AS BIGINT), 'known': c IS NOT NULL}})"
    step = "lambda a, x: {'total': CASE WHEN x.code <= -1000 THEN a.total - greatest(a.now, 1) * x.code ELSE a.total END, 'now': CASE WHEN x.code <= -1000 THEN 0 WHEN x.code = -100 THEN greatest(a.now, 1) * 100 ELSE a.now + coalesce(x.code, 0) END, 'code': CAST(0 AS BIGINT), 'known': a.known AND x.known}"
    folded = f"list_reduce({rows}, {step}, {start})"
    return f"(CASE WHEN len({words}) > 0 THEN CASE WHEN ({folded}).known THEN ({folded}).total + ({folded}).now END END)"


def name_value(t: str) -> str:
    bare = f"regexp_replace(regexp_replace({t}, '(?i)\\[STAMP\\]', ' ', 'g'), '[|\\\\]+', ' ', 'g')"
    return f"upper({collapsed(bare)})"


_D = {"due_u": "02", "due_l": "13", "made_u": "03", "made_l": "12"}


def parsed(of: str) -> str:
    return f"""
, w AS ({wide(of)})
, p0 AS (SELECT w.*, {rib_digits("t05")} AS xu, {rib_digits("t14")} AS xl, {amount_normal("t06")} AS nu, {amount_normal("t10")} AS nl, {tokens("t09")} AS toks,
  {", ".join(f"{date_parts('t' + n)} AS p{n}" for n in _D.values())} FROM w)
, p1 AS (SELECT p0.*, {rib_valid("xu")} AS rvu, {rib_valid("xl")} AS rvl, length(xu) = 20 AS wu, length(xl) = 20 AS wl, contains(xu, '?') AS qu, contains(xl, '?') AS ql,
  {amount_value("t06", "nu")} AS vu, {amount_value("t10", "nl")} AS vl, contains(t06, '?') AS aqu,
  {", ".join(f"{date_value('p' + n)} AS {k}" for k, n in _D.items())},
  list_position(list_transform(toks, lambda t: list_contains({UNITS_OF_CURRENCY}, t)), true) AS cut FROM p0)
, p2 AS (SELECT p1.*, CASE WHEN coalesce(cut, 0) = 0 THEN toks ELSE toks[1:cut-1] END AS before, CASE WHEN coalesce(cut, 0) = 0 THEN [] ELSE list_filter(toks[cut+1:], lambda t: NOT list_contains({UNITS_OF_CURRENCY}, t)) END AS after FROM p1)
, p3 AS (SELECT p2.*, {words_to_int("before")} AS dinars, coalesce({words_to_int("after")}, 0) AS millimes FROM p2)
, p AS (SELECT p3.*, CASE WHEN dinars IS NOT NULL AND millimes <= 999 THEN CAST(dinars AS DECIMAL(21,3)) + CAST(CAST(millimes AS DECIMAL(21,3)) / 1000 AS DECIMAL(21,3)) END AS vw FROM p3)
"""


_BEST = """CASE WHEN rvu THEN {u} WHEN rvl THEN {l} WHEN t05 IS NOT NULL AND NOT qu THEN {u} WHEN t14 IS NOT NULL AND NOT ql THEN {l} ELSE {u} END"""
CHECKED = f"""
, b AS (SELECT p.*, {_BEST.format(u="CASE WHEN wu THEN xu END", l="CASE WHEN wl THEN xl END")} AS rib, {_BEST.format(u="qu", l="ql")} AS rib_q, {_BEST.format(u="rvu", l="rvl")} AS rib_ok,
  CASE WHEN rvu AND rvl THEN 'merged' WHEN rvu THEN 'upper' WHEN rvl THEN 'lower' WHEN t05 IS NOT NULL AND NOT qu THEN 'upper' WHEN t14 IS NOT NULL AND NOT ql THEN 'lower' ELSE 'upper' END AS rib_source,
  CASE WHEN vu IS NOT NULL THEN vu ELSE vl END AS v, CASE WHEN t02 IS NOT NULL THEN due_u ELSE due_l END AS due, CASE WHEN t03 IS NOT NULL THEN made_u ELSE made_l END AS made,
  {solid("t01")} AS po, {solid("t17")} AS bc FROM p)
, bb AS (SELECT b.*, bank_name, substr(rib, 1, 2) AS bank_code FROM b LEFT JOIN bank ON substr(rib, 1, 2) = code)
, k AS (SELECT bb.*,
  rvu OR rvl AS rib_key_valid,
  coalesce(wu AND wl AND NOT qu AND NOT ql, false) AS clean,
  coalesce(CASE WHEN wu AND wl AND NOT qu AND NOT ql THEN xu = xl ELSE t05 IS NOT NULL AND t14 IS NOT NULL AND (rvu OR rvl) END, false) AS rib_consistent,
  coalesce(abs(vu - vl) <= 0.001, false) AS amount_consistent,
  coalesce(abs(v - vw) <= 0.001, false) AS words_match,
  coalesce(due_u = due_l, false) AS echeance_consistent,
  coalesce(made_u = made_l, false) AS creation_consistent,
  coalesce(due >= made, false) AS due_after_creation,
  coalesce(rib IS NOT NULL AND NOT rib_q AND t16 <> '', false) AS bank_known,
  coalesce(rib IS NOT NULL AND NOT rib_q AND t16 <> '' AND contains(lower(t16), lower(bank_name)), false) AS bank_matches,
  coalesce(t01 <> '' AND t17 <> '', false) AS orders_known,
  coalesce(t01 <> '' AND t17 <> '' AND (po = bc OR regexp_replace(po, '^0+', '') = regexp_replace(bc, '^0+', '')), false) AS order_matches FROM bb)
, fl AS (
  SELECT doc_id, 1 AS seq, 'rib' AS field, 'VALIDATION_ERROR' AS error_type, 'check key failed on both readings' AS message, true AS hard FROM k WHERE (t05 IS NOT NULL OR t14 IS NOT NULL) AND NOT rib_key_valid
  UNION ALL SELECT doc_id, 2, 'rib', 'INCONSISTENCY', concat('Upper rib ''', xu, ''' differs from lower ''', xl, ''''), true FROM k WHERE clean AND xu <> xl
  UNION ALL SELECT doc_id, 3, 'rib', 'STAMP_OCCLUSION', 'unreadable positions, comparison skipped', false FROM k WHERE t05 IS NOT NULL AND t14 IS NOT NULL AND NOT clean AND (qu OR ql)
  UNION ALL SELECT doc_id, 4, 'amount', 'INCONSISTENCY', concat('Upper amount ''', CAST(vu AS VARCHAR), ''' differs from lower ''', CAST(vl AS VARCHAR), ''''), true FROM k WHERE vu IS NOT NULL AND vl IS NOT NULL AND NOT amount_consistent
  UNION ALL SELECT doc_id, 5, 'amount_upper', 'FORMAT_ERROR', concat('upper amount: ', CASE WHEN nu IS NULL THEN 'empty' WHEN aqu THEN 'unreadable' WHEN nu LIKE '-%' THEN 'negative' ELSE 'number' END), false FROM k WHERE t06 IS NOT NULL AND t10 IS NOT NULL AND vu IS NULL
  UNION ALL SELECT doc_id, 6, 'amount_lower', 'FORMAT_ERROR', concat('lower amount: ', CASE WHEN nl IS NULL THEN 'empty' WHEN contains(t10, '?') THEN 'unreadable' WHEN nl LIKE '-%' THEN 'negative' ELSE 'number' END), false FROM k WHERE t06 IS NOT NULL AND t10 IS NOT NULL AND vl IS NULL
  UNION ALL SELECT doc_id, 7, 'amount', 'INCONSISTENCY', 'amount in figures differs from words', false FROM k WHERE v IS NOT NULL AND vw IS NOT NULL AND NOT words_match
  UNION ALL SELECT doc_id, 8, 'echeance', 'INCONSISTENCY', concat('Upper due date ''', {date_text("due_u")}, ''' differs from lower ''', {date_text("due_l")}, ''''), true FROM k WHERE due_u IS NOT NULL AND due_l IS NOT NULL AND due_u <> due_l
  UNION ALL SELECT doc_id, 9, 'creation_date', 'INCONSISTENCY', concat('Upper creation date ''', {date_text("made_u")}, ''' differs from lower ''', {date_text("made_l")}, ''''), true FROM k WHERE made_u IS NOT NULL AND made_l IS NOT NULL AND made_u <> made_l
  UNION ALL SELECT doc_id, 10, 'echeance', 'VALIDATION_ERROR', 'due before creation', false FROM k WHERE due < made
  UNION ALL SELECT doc_id, 11, 'rib', 'VALIDATION_ERROR', 'bank not in domiciliation', false FROM k WHERE bank_known AND NOT bank_matches
  UNION ALL SELECT doc_id, 12, 'payment_order', 'INCONSISTENCY', concat('payment order ''', po, ''' differs from barcode ''', bc, ''''), true FROM k WHERE orders_known AND NOT order_matches)
, fc AS (SELECT doc_id, count(*) FILTER (WHERE hard) AS n_hard, count(*) FILTER (WHERE NOT hard) AS n_soft FROM fl GROUP BY doc_id)
, s AS (SELECT k.*, coalesce(n_hard, 0) AS n_hard, coalesce(n_soft, 0) AS n_soft,
  CASE WHEN rib_key_valid THEN 0.4 ELSE 0.12 END + CASE WHEN rib_consistent THEN 0.3 WHEN t05 IS NOT NULL OR t14 IS NOT NULL THEN 0.15 ELSE 0 END + CASE WHEN rib_ok THEN 0.2 ELSE 0 END + CAST(coalesce(c05, 0.5) * 0.1 AS DECIMAL(9,5)) AS s_rib,
  CASE WHEN v IS NOT NULL THEN 0.4 ELSE 0.12 END + CASE WHEN amount_consistent THEN 0.3 ELSE 0.15 END + CASE WHEN v IS NOT NULL THEN 0.2 ELSE 0 END + CAST(coalesce(c06, 0.5) * 0.1 AS DECIMAL(9,5)) AS s_amount,
  CASE WHEN due IS NOT NULL THEN 0.4 ELSE 0.12 END + CASE WHEN echeance_consistent THEN 0.3 ELSE 0.15 END + CASE WHEN due IS NOT NULL THEN 0.2 ELSE 0 END + CAST(coalesce(c02, 0.5) * 0.1 AS DECIMAL(9,5)) AS s_due,
  CASE WHEN made IS NOT NULL THEN 0.4 ELSE 0.12 END + CASE WHEN creation_consistent THEN 0.3 ELSE 0.15 END + CASE WHEN made IS NOT NULL THEN 0.2 ELSE 0 END + CAST(coalesce(c03, 0.5) * 0.1 AS DECIMAL(9,5)) AS s_made
  FROM k LEFT JOIN fc USING (doc_id))
, v AS (SELECT s.*, least(s_rib, s_amount, s_due, s_made) AS confidence, n_hard > 0 OR least(s_rib, s_amount, s_due, s_made) < 0.85 AS review FROM s)
"""

_DIG = "regexp_replace({t}, '[^0-9]', '', 'g')"
_CHANGED = "(len(list_filter(generate_series(1, least(length(d1), length(d2))), lambda i: substr(d1, CAST(i AS INT), 1) <> substr(d2, CAST(i AS INT), 1))) + abs(length(d1) - length(d2)))"
MERGED = f"""
, pr AS (SELECT a.doc_id, a.roi_id, a.text AS first, CAST(a.confidence AS DECIMAL(9,4)) AS c1, q.text AS second, coalesce(q.available, false) AS available, coalesce(a.error, '') AS err
  FROM readings AS a JOIN region USING (roi_id) LEFT JOIN readings AS q ON q.doc_id = a.doc_id AND q.roi_id = a.roi_id AND q.engine = 'qwen' WHERE a.engine = 'tesseract' AND route = 'tesseract_then_qwen')
, pr1 AS (SELECT pr.*, CASE WHEN available THEN second ELSE '' END AS sec, {_DIG.format(t="first")} AS d1, {_DIG.format(t="coalesce(second, '')")} AS d2,
  {_DIG.format(t="CASE WHEN available THEN second ELSE '' END")} AS ds FROM pr)
, pr2 AS (SELECT pr1.*, {_CHANGED} AS changed, {_CHANGED.replace("d2", "ds")} AS changed_s, length(d1) AS total,
  CASE WHEN first <> '' THEN coalesce(array_to_string(list_transform(generate_series(1, length(sec)), lambda i: CASE WHEN substr(sec, CAST(i AS INT), 1) = '?' AND regexp_matches(substr(first, CAST(i AS INT), 1), '^[0-9]$') THEN substr(first, CAST(i AS INT), 1) ELSE substr(sec, CAST(i AS INT), 1) END), ''), '') ELSE sec END AS filled FROM pr1)
, pr3 AS (SELECT pr2.*, length(filled) - length(replace(filled, '?', '')) AS lft,
  CASE WHEN c1 >= 0.80 AND err = '' THEN 0 WHEN NOT available THEN 1 WHEN contains(sec, '?') THEN 2 WHEN total > 0 AND changed_s > 0.30 * total THEN 3 WHEN upper({solid("first")}) = upper({solid("sec")}) AND {solid("first")} <> '' THEN 4 ELSE 5 END AS rule FROM pr2)
, mg AS MATERIALIZED (SELECT doc_id, roi_id, changed, total, rule,
  CASE rule WHEN 2 THEN filled WHEN 5 THEN sec ELSE first END AS text,
  CASE rule WHEN 0 THEN c1 WHEN 1 THEN c1 WHEN 2 THEN CAST(greatest(0.20, 0.70 - lft * 0.05) AS DECIMAL(9,4)) WHEN 3 THEN CAST(c1 * 0.85 AS DECIMAL(9,4)) WHEN 4 THEN CAST(least(1, 0.70 + 0.30 * c1) AS DECIMAL(9,4)) ELSE CAST(least(0.75, 0.27 + 0.30 * c1) AS DECIMAL(9,4)) END AS score,
  CASE rule WHEN 2 THEN 'merged' WHEN 5 THEN 'qwen' ELSE 'tesseract' END AS source,
  CASE rule WHEN 1 THEN 'qwen_unavailable' WHEN 2 THEN CASE WHEN lft > 0 THEN concat('partial_unreadable_', CAST(lft AS VARCHAR), '_chars') ELSE '' END WHEN 3 THEN 'qwen_rejected_divergence' WHEN 5 THEN 'tess_qwen_disagree' ELSE '' END AS flags FROM pr3)
, sg AS (SELECT a.doc_id, a.roi_id, text, CAST(confidence AS DECIMAL(9,4)) AS score, 'tesseract' AS source, CASE WHEN available THEN '' ELSE 'tesseract_unavailable' END AS flags FROM readings AS a JOIN region USING (roi_id) WHERE route = 'tesseract' AND engine = 'tesseract'
  UNION ALL SELECT a.doc_id, a.roi_id, CASE WHEN available THEN text ELSE '' END, CAST(CASE WHEN available THEN 0.70 ELSE 0 END AS DECIMAL(9,4)), CASE WHEN available THEN 'qwen' ELSE 'none' END, CASE WHEN available THEN '' ELSE 'qwen_unavailable' END FROM readings AS a JOIN region USING (roi_id) WHERE route = 'qwen' AND engine = 'qwen')
, bc0 AS (SELECT coalesce(a.doc_id, z.doc_id) AS doc_id, coalesce(z.text, '') AS dec, {_DIG.format(t="coalesce(a.text, '')")} AS rd, a.confidence FROM (SELECT * FROM readings WHERE roi_id = 'R17' AND engine = 'tesseract') AS a FULL JOIN (SELECT * FROM readings WHERE roi_id = 'R17' AND engine = 'pyzbar') AS z ON a.doc_id = z.doc_id)
, bcd AS (SELECT doc_id, 'R17' AS roi_id, CASE WHEN dec <> '' THEN dec ELSE rd END AS text, CAST(CASE WHEN dec <> '' THEN 1 WHEN rd <> '' THEN confidence ELSE 0 END AS DECIMAL(9,4)) AS score, CASE WHEN dec <> '' THEN 'barcode_pyzbar' WHEN rd <> '' THEN 'barcode_tesseract_ocrb' ELSE 'barcode_none' END AS source, CASE WHEN dec = '' AND rd = '' THEN 'barcode_unreadable' ELSE '' END AS flags FROM bc0)
, rs AS MATERIALIZED (SELECT doc_id, roi_id, text, score, source, flags FROM mg UNION ALL SELECT * FROM sg UNION ALL SELECT * FROM bcd)
"""

GEOMETRY = """
, bx0 AS (SELECT doc_id, roi_id, tier, pages_m.w AS pw, pages_m.h AS ph,
  greatest(0, CAST(trunc(region.x * pages_m.w - region.w * pages_m.w * padding) AS INT)) AS bx, greatest(0, CAST(trunc(region.y * pages_m.h - region.h * pages_m.h * padding) AS INT)) AS byy,
  CAST(trunc(region.w * pages_m.w + region.w * pages_m.w * padding * 2) AS INT) AS bw0, CAST(trunc(region.h * pages_m.h + region.h * pages_m.h * padding * 2) AS INT) AS bh0,
  greatest(0, CAST(trunc(region.x * pages_m.w) AS INT)) AS ux, greatest(0, CAST(trunc(region.y * pages_m.h) AS INT)) AS uy, CAST(trunc(region.w * pages_m.w) AS INT) AS uw0, CAST(trunc(region.h * pages_m.h) AS INT) AS uh0
  FROM pages_m CROSS JOIN region)
, bx1 AS (SELECT doc_id, roi_id, tier, bx AS x, byy AS y, least(pw - bx, bw0) AS w, least(ph - byy, bh0) AS h FROM bx0)
, bu AS (SELECT doc_id, roi_id, tier, ux AS x, uy AS y, least(pw - ux, uw0) AS w, least(ph - uy, uh0) AS h FROM bx0)
, ss AS (SELECT doc_id, seq, method, colour, cx, cy, greatest(rx, ry) AS rx, greatest(rx, ry) AS ry, round(least(1.0, density + 0.5), 3) AS confidence FROM stamps_m WHERE method = 'hough' AND density >= 0.08
  UNION ALL SELECT doc_id, seq, method, colour, cx, cy, greatest(rx, ry), greatest(rx, ry), CASE WHEN n_points < 5 THEN 0.5 ELSE round(least(1.0, area * CAST(0.8 AS DOUBLE) / (greatest(rx * ry, 1) * CAST(3.141592653589793 AS DOUBLE))), 3) END FROM stamps_m WHERE method = 'contour' AND area >= 2000)
, sb AS (SELECT *, greatest(0, cx - rx - 10) AS x1, greatest(0, cy - ry - 10) AS y1, cx + rx + 10 AS x2, cy + ry + 10 AS y2 FROM ss)
, ov0 AS (SELECT sb.doc_id, seq, roi_id, least(x2, x + w) - greatest(x1, x) AS ow, least(y2, y + h) - greatest(y1, y) AS oh, w, h FROM sb JOIN bu ON sb.doc_id = bu.doc_id)
, ov AS (SELECT doc_id, seq, roi_id, CAST(ow * oh AS DOUBLE) / greatest(1, w * h) AS share FROM ov0 WHERE ow > 0 AND oh > 0 AND CAST(ow * oh AS DOUBLE) / greatest(1, w * h) >= 0.10)
, al0 AS (SELECT *, coalesce(least(1.0, CAST(border_w * border_h AS DOUBLE) / (w * h) * 1.2), 0.3) AS border, coalesce(barcode_bottom, h - 1) AS bot, coalesce(header_top, 0) AS top FROM pages_m)
, al1 AS (SELECT *, (header_top IS NOT NULL OR barcode_bottom IS NOT NULL) AND bot > top AS anchored FROM al0)
, al2 AS (SELECT *, CASE WHEN anchored THEN (5 + 2 * CAST(header_top IS NOT NULL AS INT) + 2 * CAST(barcode_bottom IS NOT NULL AS INT)) / 10.0 ELSE 0.2 END AS score2 FROM al1)
, al AS (SELECT *, CASE WHEN border < 0.7 AND score2 > border THEN score2 ELSE border END AS conf, border < 0.7 AND score2 > border AS snd FROM al2)
, sk AS (SELECT pages_m.doc_id, coalesce(median(CASE WHEN abs(theta_deg - 90) <= 20 THEN theta_deg - 90 END), 0) AS skew FROM pages_m LEFT JOIN angles_m USING (doc_id) GROUP BY pages_m.doc_id)
"""
