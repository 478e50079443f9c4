"""Secret scan with a trigram inverted index, in DataFrame operations only.

From every rule's regular expression a Boolean query over trigrams is derived: a conjunction of clauses, each a
disjunction of trigram sets that all strings of one alternative hold.  Of such a set the ``ASKED`` trigrams that are
rarest in plain text are asked for: the others follow from them in nearly all texts, and looking for one costs as much
as it saves.  The index lists, for each trigram that some rule asks for, the texts that hold it (by text hash, ASCII
case folded).  Postings are intersected by counting, per
text, the trigrams met of each alternative, the clauses met of each rule.  Candidates alone are verified with the
regular expression; a rule without a mandatory trigram scans all texts.

Spans are code point offsets, end exclusive.  Native functions give a regex's matches but not their places: the text
split at the regex gives what stands between, and running sums of both lengths give the places.

Edge cases: a null text is empty.  A hash shared by two texts adds a candidate, which verification settles.  Copies
of a text are one posting each trigram.  A text without spans has the digest of the empty string.  Matches of one kind do
not overlap, those of several kinds may, and all are listed.  Texts of any length are searched whole.  Repeated rows
each give a row, an empty table none.  Extra columns are kept whatever their names; one called as the result is replaced.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, cut, documents, own_name


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0  # the group whose length counts
    least: int = 0  # matches with a shorter group are dropped


#: The three base kinds, in order, then more.
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |DSA |EC |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

# Trigram queries -----------------------------------------------------------------------------------------------------

MOST_STRINGS = 16
#: Trigrams asked for of each alternative.
ASKED = 2
#: Letters by how often plain text holds them; what is not here is rarer.
FREQUENT = "etaoinsrhldcumfpgwybvk"


def _strings(node) -> set[str] | None:
    """The strings that a parsed node can match, ASCII case folded; None if there are too many."""
    out = {""}
    for op, arg in node:
        if op is C.LITERAL:
            own = {chr(arg).lower()}
        elif op is C.IN and arg[0][0] is not C.NEGATE:
            own = set()
            for kind, x in arg:
                if kind is C.LITERAL:
                    own.add(chr(x).lower())
                elif kind is C.RANGE and x[1] - x[0] < MOST_STRINGS:
                    own |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None
        elif op is C.SUBPATTERN:
            own = _strings(arg[3])
        elif op is C.BRANCH:
            parts = [_strings(x) for x in arg[1]]
            own = None if None in parts else set().union(*parts)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] == 1:
            own = _strings(arg[2])
            own = None if own is None else own | {""} if arg[0] == 0 else own
        else:
            own = None
        if own is None or len(own) * len(out) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def trigram_query(regex: str) -> list[list[list[str]]]:
    """The clauses of a regex: every match holds, for each clause, all trigrams of one of its alternatives."""
    clauses, run = [], {""}

    def close() -> None:
        nonlocal run
        if all(len(s) >= 3 for s in run):
            alternatives = sorted({tuple(sorted({s[i : i + 3] for i in range(len(s) - 2)})) for s in run})
            clauses.append([list(a) for a in alternatives])
        run = {""}

    for item in parser.parse(regex):
        own = _strings([item])
        if own is not None and len(own) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
        else:
            close()
            if own is not None:
                run = own
            elif item[0] in (C.MAX_REPEAT, C.MIN_REPEAT) and item[1][0] >= 1 and (inner := _strings(item[1][2])) is not None:
                run = inner
                close()
    close()
    return clauses


def asked(regex: str) -> list[list[list[str]]]:
    """The query of a regex with the rarest trigrams of each alternative alone; a match still holds them."""
    common = lambda t: sum(len(FREQUENT) - FREQUENT.index(c) if c in FREQUENT else 0 for c in t)
    return [[sorted(sorted(a, key=lambda t: (common(t), t))[:ASKED]) for a in clause] for clause in trigram_query(regex)]


# Spans ---------------------------------------------------------------------------------------------------------------

_BLOCK = 256


def _text(s: str) -> str:
    return "r'" + s.replace("'", "\\x27") + "'"


def rule_spans(text: str, rule: Rule, order: int) -> Column:
    """array<struct<s, k, e>> of a rule in the column ``text``: start, order of the kind, end."""
    x = _text(rule.regex)
    # Lengths of what stands before each match and of the match; sums by blocks keep long lists of matches cheap.
    pairs = f"zip_with(slice(split({text}, {x}, -1), 1, size(m)), m, (b, w) -> struct(length(b) as b, length(w) as w))"
    sums = f"transform(sequence(0, size(l) div {_BLOCK}), j -> aggregate(slice(l, j * {_BLOCK} + 1, {_BLOCK}), 0, (a, q) -> a + q.b + q.w))"
    before = f"aggregate(slice(t, 1, i div {_BLOCK}), 0, (a, q) -> a + q) + aggregate(slice(l, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK}), 0, (a, q) -> a + q.b + q.w)"
    each = f"transform(l, (p, i) -> struct({before} + p.b as s, {order} as k, {before} + p.b + p.w as e, m[cast(i as int)] as w))"
    let = lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    found = let("m", f"regexp_extract_all({text}, {x}, 0)", let("l", pairs, let("t", sums, each.replace("(p, i)", "(p, i)"))))
    if rule.least:
        found = f"filter({found}, p -> length(regexp_extract(p.w, {x}, {rule.group})) >= {rule.least})"
    kept = f"transform({found}, p -> struct(cast(p.s as bigint) as s, p.k as k, cast(p.e as bigint) as e))"
    return F.expr(f"case when {text} rlike {x} then {kept} else cast(array() as array<struct<s: bigint, k: int, e: bigint>>) end")


# Index ---------------------------------------------------------------------------------------------------------------


def postings(texts: DataFrame, rules=RULES) -> DataFrame:
    """The inverted index (trigram, h) of ``texts`` (h, text) over the trigrams that the rules ask for."""
    wanted = sorted({t for r in rules for clause in asked(r.regex) for a in clause for t in a})
    low = texts.select("h", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in wanted]))
    return low.select("h", F.explode(held).alias("trigram")).distinct()


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(h, rules): the texts whose postings satisfy the queries of the rules named."""
    spark = index.sparkSession
    terms, clauses = [], []
    for r in rules:
        query = asked(r.regex)
        clauses.append((r.kind, len(query)))
        terms += [(t, r.kind, c, a, len(alternative)) for c, clause in enumerate(query) for a, alternative in enumerate(clause) for t in alternative]
    terms = spark.createDataFrame(terms, "trigram string, rule string, clause int, alternative int, need long")
    clauses = spark.createDataFrame([x for x in clauses if x[1]], "rule string, clauses long")
    met = index.join(F.broadcast(terms), "trigram").groupBy("h", "rule", "clause", "alternative", "need").agg(F.count("*").alias("got")).where("got = need")
    full = met.groupBy("h", "rule").agg(F.count_distinct("clause").alias("n")).join(F.broadcast(clauses), "rule").where("n = clauses")
    return full.groupBy("h").agg(F.collect_set("rule").alias("rules"))


def scan(docs: DataFrame, into: str, rules=RULES) -> DataFrame:
    """``docs`` with the column ``into``: array<struct<s, k, e>> of all spans of ``text``, by start, then kind."""
    key, told, text = (own_name(docs, f"{into}_{x}") for x in ("h", "rules", "t"))
    keyed = docs.withColumn(text, F.coalesce("text", F.lit(""))).withColumn(key, F.xxhash64(text))
    hits = cut(candidates(postings(keyed.select(F.col(key).alias("h"), F.col(text).alias("text")), rules), rules), "candidates")
    hits = hits.select(F.col("h").alias(key), F.col("rules").alias(told))
    joined = keyed.join(bounded_broadcast(hits), key, "left")
    found = []
    for i, r in enumerate(rules):
        spans = rule_spans(text, r, i)
        none = F.expr("cast(array() as array<struct<s: bigint, k: int, e: bigint>>)")
        found.append(spans if not trigram_query(r.regex) else F.when(F.array_contains(told, r.kind), spans).otherwise(none))
    return joined.withColumn(into, F.array_sort(F.concat(*found))).drop(key, told, text)


def listed(spans: Column, rules=RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.get(kinds, p["k"]), p["s"], p["e"])), ",")


def masked(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by a mark, and ``n_chars``, if there, the new length.

    Overlapping spans become one mark (of the kind that starts first).  Texts without spans stay as they are.
    """
    into = own_name(docs, "secrets")
    out = scan(docs, into, rules)
    kinds = ", ".join(f"'{r.kind}'" for r in rules)
    fold = (
        f"aggregate({into}, cast(struct(0 as at, array() as parts) as struct<at: bigint, parts: array<string>>), (a, p) -> case when p.s >= a.at "
        f"then struct(p.e as at, concat(a.parts, array(substring(text, cast(a.at as int) + 1, cast(p.s - a.at as int)), concat('[', array({kinds})[p.k], ']'))) as parts) "
        f"else struct(greatest(a.at, p.e) as at, a.parts as parts) end, a -> concat(array_join(a.parts, ''), substring(text, cast(a.at as int) + 1)))"
    )
    out = out.withColumn("text", F.expr(f"case when size({into}) > 0 then {fold} else text end"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(into) > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    out = scan(documents(spark, sf_dir).select("doc_id", "text"), "found")
    count = lambda i: F.size(F.filter("found", lambda p: p["k"] == i)).cast("long")
    base = listed(F.filter("found", lambda p: p["k"] < len(BASE)))
    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)], F.sha2(base, 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
