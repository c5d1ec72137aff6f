"""Personal data by candidate gradient boosting, in SQL expressions throughout.

Base spans (email, ip, card, phone) are regular expressions with checks and always stay. High-recall generators propose further,
overlapping spans: national phone numbers, spelled-out addresses, cards with other separators, IPv6. Boosted trees of depth two score each
candidate by format (digits, separators, check sum) and context (words and signs around it, as far as the next candidate of its kind); a threshold per
kind, calibrated on templates that the trees have not seen, selects. Selected spans that overlap a base span, or a better candidate, fall away.

The trees are fitted once per session on `training_rows` labelled candidates, which Spark generates from templates and measures with the very
expressions used on documents; every third template is kept apart to calibrate. They become nested CASE expressions, so documents never leave the JVM.

All patterns are linear in the text: loops are possessive, and starts inside a run of the same characters are ruled out by look-behind. Places of
matches are running sums taken in chunks of `CHUNK`, and overlaps are looked up by chunk, so a text with very many matches does not cost their square.

Defined cases. Null or empty text: no spans. Repeated rows: one result each. Null id: kept. Texts of any length are scanned whole.
Empty table: no rows. Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick

KINDS = ("email", "ip", "card", "phone")

LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: After the end of the last match (\G) or where no character of the same class stands before: the leftmost start of a run.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap signs that a text can hold a match at all.
HINT = {"email": "instr(text, '@') > 0", "ip": "instr(text, '.') > 0", "card": "true", "phone": "instr(text, '+') > 0"}

HEX = "[0-9A-Fa-f]{1,4}"
CANDIDATES = {
    "email": rf"(?<!{LOCAL}){LOCAL}++ ?(?:\(at\)|\[at\]|\{{at\}}|(?i: at )) ?{HOST}++(?: ?(?:\(dot\)|\[dot\]|\{{dot\}}|(?i: dot )|\.) ?{HOST}++)++",
    "ip": rf"(?<![0-9A-Za-z:.])(?:(?:{HEX}:){{3,7}}{HEX}|(?:{HEX}(?::{HEX}){{0,6}})?::(?:{HEX}(?::{HEX}){{0,6}})?)(?![0-9A-Za-z:]|\.[0-9A-Fa-f])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}[./_][0-9]{4}[./_][0-9]{4}[./_][0-9]{1,7}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-])",
}

GOOD = "phone|tel|call|fax|mobile|cell|dial|ring|mail|contact|write|reach|card|visa|pay|charge|credit|host|addr|client|server|login|user|from"
BAD = "version|order|isbn|part|serial|date|page|table|section|ratio|score|total|item|release|invoice|lot|chapter|time|log|result|range"

FEATURES = {
    "digits": "length(regexp_replace(c.s, '[^0-9]', ''))",
    "length": "length(c.s)",
    "seps": "size(array_distinct(split(regexp_replace(c.s, '[^ ().:/_-]', ''), '')))",
    "dots": "length(regexp_replace(c.s, '[^.]', ''))",
    "luhn": "if(LUHN, 1, 0)",
    "parens": "if(instr(c.s, '(') > 0, 1, 0)",
    "good": f"if(lower(c.before) rlike '(?:{GOOD})[a-z]*[^a-z0-9]{{0,12}}$', 1, 0)",
    "bad": f"if(lower(c.before) rlike '(?:{BAD})[a-z]*[^a-z0-9]{{0,12}}$', 1, 0)",
    "money": r"if(c.before rlike '[$#=/]\\s*$', 1, 0)",
    "after_unit": r"if(c.after rlike '^\\s*(?:%|kg|km|ms|px)', 1, 0)",
    "upper": "length(regexp_replace(c.s, '[^A-Z]', ''))",
    "colon": r"if(c.before rlike ':\\s*$', 1, 0)",
    "groups": "size(regexp_extract_all(c.s, '[0-9A-Fa-f]+', 0))",
    "letters": "length(regexp_replace(c.s, '[^A-Za-z]', ''))",
    "no_word_before": r"if(c.before rlike '[A-Za-z][^A-Za-z]{0,3}$', 0, 1)",
    "goes_on": r"if(c.after rlike '^[A-Za-z0-9_(<=]', 1, 0)",
    "spelled": r"if(lower(c.s) rlike '[\\(\\[](?:at|dot)[\\)\\]]', 1, 0)",
}


def _luhn(digits: str) -> str:
    """SQL: the digits pass the Luhn check."""
    value = f"cast(substring({digits}, length({digits}) - i, 1) as int)"
    twice = f"if(i % 2 = 1, if({value} > 4, 2 * {value} - 9, 2 * {value}), {value})"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (sum, i) -> sum + {twice}) % 10 = 0"


def _strip(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


CHECK = {
    "email": "true",
    "ip": "forall(split(x.s, '[.]'), part -> length(ltrim('0', part)) <= 3 and cast(if(length(ltrim('0', part)) > 3, '999', part) as int) <= 255)",
    "card": f"length({_strip('x.s')}) between 12 and 19 and {_luhn(_strip('x.s'))}",
    "phone": f"length({_strip('x.s')}) between 9 and 15",
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


CHUNK = 256


def _let(name: str, value: str, body: str) -> str:
    """SQL: body with name standing for value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _running(lengths: str) -> str:
    """SQL: running sums of an array of numbers; an array grows element by element only within a chunk."""
    empty = "cast(array() as array<int>)"
    chunk = f"aggregate(slice(l, k * {CHUNK} + 1, {CHUNK}), named_struct('at', 0, 'out', {empty}), (a, x) -> named_struct('at', a.at + x, 'out', concat(a.out, array(a.at + x))))"
    starts = f"aggregate(parts, named_struct('at', 0, 'out', {empty}), (a, x) -> named_struct('at', a.at + x.at, 'out', concat(a.out, array(a.at))), a -> a.out)"
    shifted = _let("starts", starts, "flatten(zip_with(parts, starts, (x, o) -> transform(x.out, y -> y + o)))")
    return _let("l", lengths, _let("parts", f"transform(sequence(0, greatest(size(l) - 1, 0) div {CHUNK}), k -> {chunk})", shifted))


def _located(pattern: str, hint: str, kind: str, around: int = 0) -> str:
    """SQL: array of struct(kind, start, stop, s, before, after) of all matches, by the lengths of the matches and of the text between them.

    before and after hold at most `around` characters of the text between this match and its neighbours.
    """
    empty = "cast(array() as array<struct<kind:int,start:int,stop:int,s:string,before:string,after:string>>)"
    ends = _running("zip_with(f, slice(g, 1, size(f)), (s, b) -> length(s) + length(b))")
    sides = f"right(y.b, {around}) as before, left(y.a, {around}) as after" if around else "'' as before, '' as after"
    rows = f"""zip_with(zip_with(f, e, (s, z) -> struct(s as s, z as z)), zip_with(slice(g, 1, size(f)), slice(g, 2, size(f)), (b, a) -> struct(b as b, a as a)),
        (x, y) -> struct({KINDS.index(kind)} as kind, x.z - length(x.s) as start, x.z as stop, x.s as s, {sides}))"""
    body = _let("f", f"regexp_extract_all(text, {_quoted(pattern)}, 0)", _let("g", f"split(text, {_quoted(pattern)}, -1)", _let("e", ends, rows)))
    return f"if({hint} and text rlike {_quoted(pattern.replace(chr(92) + 'G', '^'))}, {body}, {empty})"


def _chunks(spans: str) -> str:
    """SQL: spans (an array ordered by start) in chunks: struct(lo, hi, own), lo the first start, hi the last stop."""
    part = _let("own", f"slice({spans}, k * {CHUNK} + 1, {CHUNK})", "struct(element_at(own, 1).start as lo, array_max(transform(own, y -> y.stop)) as hi, own as own)")
    return f"if(size({spans}) = 0, array(), transform(sequence(0, greatest(size({spans}) - 1, 0) div {CHUNK}), k -> {part}))"


def _overlaps(chunks: str, condition: str = "true") -> str:
    """SQL: some span y of the chunks overlaps x, with the condition."""
    return f"exists({chunks}, p -> p.lo < x.stop and x.start < p.hi and exists(p.own, y -> y.start < x.stop and x.start < y.stop and {condition}))"


@dataclass(frozen=True)
class Params:
    training_rows: int = 4_000
    trees: int = 24
    rate: float = 0.3
    precision: float = 0.97
    context_chars: int = 24


# --- boosted trees ------------------------------------------------------------------------------------------------------

#: Templates of labelled candidates: words before, value (9 stands for any digit, F for a hexadecimal one, other capitals for themselves), words after, label.
TEMPLATES = [
    ("phone: ", "(999) 999-9999", ", and", 1), ("call ", "999-999-9999", " for", 1), ("tel. ", "999.999.9999", ".", 1), ("fax ", "999 999 9999", "", 1), ("reach me at ", "(99) 9999 9999", " today", 1),
    ("mobile ", "9999 999 999", "!", 1), ("dial ", "999-999-9999", " now", 1), ("ring us on ", "(999) 999 9999", ".", 1), ("my cell is ", "999.999.9999", " ok", 1), ("contact: ", "999-9999-9999", "", 1),
    ("on ", "(999) 999-9999", " or", 1), ("ask for ann, ", "(9999) 999-9999", ".", 1), ("text ", "999-999-9999", "?", 1), ("office ", "(999) 999-9999", " ext", 1), ("or ", "(99) 9999-9999", ",", 1),
    ("order ", "999-999-9999", " was", 0), ("isbn ", "999-999-9999", ".", 0), ("page ", "99 999 999", " of", 0), ("total $", "99 999 999", "", 0), ("version ", "99.999.999", " is", 0),
    ("the ", "999 999 999", " people", 0), ("date ", "99-9999-9999", ",", 0), ("ratio ", "999.999.999", "", 0), ("of ", "99 999 9999", " kg", 0), ("invoice ", "999-999-9999", " paid", 0),
    ("lot ", "9999 999 999", ".", 0), ("release ", "999.999.9999", "", 0), ("range ", "999-9999-9999", " px", 0), ("about ", "99 999 999", " km", 0), ("score ", "999 999 9999", "", 0),
    ("mail ", "ann(at)host9(dot)org", " for", 1), ("write to ", "b.c [at] host9 [dot] com", ".", 1), ("contact ", "team at host9 dot net", " soon", 1), ("of ", "x9(at)host9.org", ",", 1), ("login: ", "jo.lee[at]site9.net", "", 1),
    ("address ", "info {at} firm9 {dot} io", " or", 1), ("e-mail: ", "k9 AT host9 DOT com", "", 1), ("user ", "sam(at)uni9(dot)edu", "!", 1), ("send it to ", "help [at] desk9.org", ".", 1), ("- ", "m.o(at)mail9(dot)de", "", 1),
    ("meet ", "us at noon dot com", " we", 0), ("look ", "in at page dot two", "", 0), ("we are ", "there at item.9", " so", 0), ("they stay ", "late at work.And", " then", 0), ("it was ", "sold at market.The", " price", 0),
    ("he was ", "born at sea.He", " grew", 0), ("time ", "9 at night.We", " left", 0), ("you arrive ", "home at last.So", "", 0), ("priced ", "9 at 9.99", " each", 0), ("she works ", "hard at home.It", " is", 0),
    ("card ", "4999.9999.9999.9999", " exp", 1), ("visa ", "4999/9999/9999/9999", "", 1), ("pay with ", "5999_9999_9999_9999", ".", 1), ("credit ", "4999.9999.9999.9999", ",", 1), ("charge ", "5999/9999/9999/9999", " now", 1), ("card no: ", "4999_9999_9999_999", "", 1),
    ("serial ", "9999.9999.9999.9999", "", 0), ("part ", "9999/9999/9999/99", " fits", 0), ("the ", "9999.9999.9999.9", "", 0), ("log ", "9999/9999/9999/9999", " read", 0), ("table ", "9999.9999.9999.99", "", 0), ("item ", "9999_9999_9999_9", " sold", 0),
    ("host ", "FFFF:FFFF:FFFF:FFFF:FFFF:FFFF:FFFF:FFFF", " is", 1), ("client ", "FFFF:FFF:FF:F:FFFF:FFF:FFFF:FF", "", 1), ("from ", "FFFF:FFFF:FFFF:FFFF:FFFF:FFFF:FFFF:FFFF", ".", 1), ("server ", "2999:dF9::F", " up", 1), ("addr: ", "fe99::FFFF:FFFF", "", 1),
    ("ping ", "2999:FFFF::F9", " ok", 1), ("route ", "FFFF:FFFF:FFFF::9F", ",", 1), ("login from ", "FFFF:FFFF:FFFF:FFFF:FFFF:FFFF:FFFF:FFFF", "", 1), ("via ", "fd99:FFF9::9", ".", 1),
    ("at ", "99:99:99:99", "", 0), ("ratio ", "9:9:99:9", " of", 0), ("date ", "99:99:99:9999", "", 0), ("time ", "99:99:99:999", " on", 0), ("use ", "Add::Bee", " to", 0), ("call ", "Face::", "new", 0), ("result ", "9:99:9:99", "", 0), ("see ", "Dead::Cafe", "(x)", 0), ("in ", "::", "main", 0),
]


def _stump_values(x: np.ndarray) -> np.ndarray:
    v = np.unique(x)
    return (v[1:] + v[:-1]) / 2


def boost(x: np.ndarray, y: np.ndarray, trees: int, rate: float) -> list[tuple]:
    """Logistic boosting with trees of depth two: (feature, cut, (left feature, cut, low, high), (right ...)) with Newton leaf values."""

    def leaf(r: np.ndarray, h: np.ndarray) -> float:
        return float(rate * r.sum() / (h.sum() + 1.0))

    def best(rows: np.ndarray, r: np.ndarray, h: np.ndarray) -> tuple[float, int, float]:
        top = (-1.0, 0, np.inf)
        for f in range(x.shape[1]):
            for cut in _stump_values(x[rows, f]):
                low = rows[x[rows, f] <= cut]
                high = rows[x[rows, f] > cut]
                gain = r[low].sum() ** 2 / (h[low].sum() + 1) + r[high].sum() ** 2 / (h[high].sum() + 1)
                if gain > top[0] + 1e-12:
                    top = (gain, f, float(cut))
        return top

    score, out = np.zeros(len(y)), []
    everything = np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        r, h = y - p, p * (1 - p)
        _, f, cut = best(everything, r, h)
        tree = [f, cut]
        for side in (everything[x[:, f] <= cut], everything[x[:, f] > cut]):
            _, g, c = best(side, r, h) if len(side) else (0, 0, np.inf)
            low, high = side[x[side, g] <= c], side[x[side, g] > c]
            values = (leaf(r[low], h[low]), leaf(r[high], h[high]))
            score[low] += values[0]
            score[high] += values[1]
            tree.append((g, c, *values))
        out.append(tuple(tree))
    return out


def apply_trees(trees: list[tuple], x: np.ndarray) -> np.ndarray:
    score = np.zeros(len(x))
    for f, cut, left, right in trees:
        for (g, c, low, high), side in ((left, x[:, f] <= cut), (right, x[:, f] > cut)):
            score[side] += np.where(x[side, g] <= c, low, high)
    return score


def tree_sql(trees: list[tuple], names: list[str], row: str) -> str:
    def split(g: int, c: float, low: float, high: float) -> str:
        return f"{low!r}D" if not np.isfinite(c) else f"if({row}.{names[g]} <= {c!r}D, {low!r}D, {high!r}D)"

    return " + ".join(f"if({row}.{names[f]} <= {cut!r}D, {split(*left)}, {split(*right)})" for f, cut, left, right in trees)


def _candidate_sql(p: Params) -> str:
    """SQL: candidates of all kinds with their features."""
    found = "concat(" + ", ".join(_located(CANDIDATES[k], "true", k, p.context_chars) for k in KINDS) + ")"
    digits = _strip("c.s")
    features = ", ".join(f"cast({sql.replace('LUHN', f'length({digits}) > 0 and ' + _luhn(digits))} as double) as {name}" for name, sql in FEATURES.items())
    return f"transform({found}, c -> struct(c.kind as kind, c.start as start, c.stop as stop, cast(c.kind as double) as kind_no, {features}))"


_fitted: dict[tuple, tuple[str, dict[int, float]]] = {}


def fitted(spark: SparkSession, p: Params) -> tuple[str, dict[int, float]]:
    """The trees as SQL over a candidate `c`, and the score that a candidate of each kind must reach."""
    key = (p,)
    if key in _fitted:
        return _fitted[key]
    names = ["kind_no", *FEATURES]
    values = ", ".join(f"struct({_quoted(before)} as before, {_quoted(value)} as value, {_quoted(after)} as after, {label} as label, {i % 3 == 2} as apart)" for i, (before, value, after, label) in enumerate(TEMPLATES))
    digit = "if(x = '9', cast(pmod(xxhash64(id, i), 10) as string), if(x = 'F', lower(hex(pmod(xxhash64(id, i, 1), 16))), x))"
    rows = (
        spark.range(0, p.training_rows, 1, 4).withColumn("t", F.expr(f"element_at(array({values}), 1 + cast(pmod(xxhash64(id), {len(TEMPLATES)}) as int))"))
        .withColumn("text", F.expr(f"concat(if(id % 2 = 0, 'the ', 'Then, '), t.before, array_join(transform(split(t.value, ''), (x, i) -> {digit}), ''), t.after)"))
        .withColumn("c", F.expr(f"get({_candidate_sql(p)}, 0)")).where("c is not null").select("id", "t.label", "t.apart", *(f"c.{n}" for n in names))
    ).toPandas()  # fmt: skip  # at most training_rows
    rows = rows.sort_values("id", ignore_index=True)
    x, y, apart = rows[names].to_numpy(dtype=float), rows["label"].to_numpy(dtype=float), rows["apart"].to_numpy(dtype=bool)
    trees = boost(x[~apart], y[~apart], p.trees, p.rate)
    score = apply_trees(trees, x)
    bounds = {}
    for kind in range(len(KINDS)):
        own = np.flatnonzero(apart & (x[:, 0] == kind))
        bounds[kind] = np.inf
        for cut in sorted(set(np.round(score[own], 6)), reverse=True):  # the lowest score with the wanted precision at and above it
            if y[own[score[own] >= cut - 1e-6]].mean() < p.precision:
                bounds[kind] = (bounds[kind] + float(cut)) / 2  # halfway to the first score that fails
                break
            bounds[kind] = float(cut) - 1e-6
    _fitted[key] = (tree_sql(trees, names, "c"), bounds)
    return _fitted[key]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """doc_id, text, base and spans: arrays of struct(kind, start, stop), ordered by start, then kind; the end is exclusive."""
    score, bounds = fitted(docs.sparkSession, p)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = "concat(" + ", ".join(f"filter({_located(BASE[k], HINT[k], k)}, x -> {CHECK[k]})" for k in KINDS) + ")"
    order = "(a, b) -> case when a.start < b.start then -1 when a.start > b.start then 1 else a.kind - b.kind end"
    rows = rows.withColumn("base", F.expr(f"array_sort(transform({base}, x -> struct(x.kind as kind, x.start as start, x.stop as stop)), {order})"))
    bound = "case c.kind " + " ".join(f"when {k} then {'double(' + chr(39) + 'Infinity' + chr(39) + ')' if not np.isfinite(v) else repr(v) + 'D'}" for k, v in bounds.items()) + " end"
    chosen = f"filter(transform({_candidate_sql(p)}, c -> struct(c.kind as kind, c.start as start, c.stop as stop, {score} as score, {bound} as least)), x -> x.score >= x.least)"
    rows = rows.withColumn("chosen", F.expr(f"array_sort({chosen}, {order})"))
    free = _let("chunks", _chunks("base"), f"filter(chosen, x -> not {_overlaps('chunks')})")
    rows = rows.withColumn("chosen", F.expr(f"if(size(chosen) = 0 or size(base) = 0, chosen, {free})"))
    better = "(y.score > x.score or (y.score = x.score and (y.start < x.start or (y.start = x.start and y.kind < x.kind))))"
    left = _let("chunks", _chunks("chosen"), f"filter(chosen, x -> not {_overlaps('chunks', better)})")
    extra = f"transform(if(size(chosen) < 2, chosen, {left}), x -> struct(x.kind as kind, x.start as start, x.stop as stop))"
    return rows.select("doc_id", "text", "base", F.expr(f"array_sort(concat(base, {extra}), {order})").alias("spans"))


def span_text(column: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({column}, x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.stop)), ',')"


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """doc_id and the text with every span replaced by its kind in brackets (overlapping spans as one, named after the first)."""
    found = find(docs, id_col, text_col, p)
    names = ", ".join(f"'[{k}]'" for k in KINDS)
    step = f"""(acc, x) -> named_struct('at', greatest(acc.at, x.stop), 'out', if(x.start >= acc.at,
        concat(acc.out, substring(text, acc.at + 1, x.start - acc.at), element_at(array({names}), x.kind + 1)), acc.out))"""
    return found.select("doc_id", F.expr(f"aggregate(spans, named_struct('at', 0, 'out', ''), {step}, acc -> concat(acc.out, substring(text, acc.at + 1)))").alias("text"))
