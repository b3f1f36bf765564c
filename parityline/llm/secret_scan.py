"""Secret scan with linking of credentials that come in several parts.

Base findings are regex matches of three kinds: assignments, access identifiers and long
hexadecimal runs. Weak candidates are parts that mean little alone:

- ``id``: an upper-case identifier of 16 characters or more, with letters and digits, that
  is no access identifier,
- ``key``: 32 or more characters of the Base64 alphabets in both cases, with a digit or with
  as many capitals as no words have, or in capitals with digits, not in the host or path of
  a web address; with points and dashes only if its capitals are not those of a title,
- ``endpoint``: a web address, or a host with a port.

A weak candidate is reported only if a complementary part lies in the same scope: an
identifier needs a secret, a secret an identifier or an endpoint, an endpoint a secret.
Access identifiers are identifiers; assignments and hexadecimal runs are secrets. Two
parts share a scope if at least one and at most ``SCOPE`` code points of one document lie
between them; parts that overlap or touch do not complement each other.

Only DataFrame functions are used. Texts are scanned where they lie, not shuffled. Spans
are looked up by (document, cell), with cells as long as a scope; of the parts that start,
or stop, in a cell, the first and the last of each role decide, so a cell full of parts
costs no more than one with a few.

Defined results: a null text counts as empty; spans count code points, ends are
exclusive; rows that repeat are reported each; rows with a null id are scanned too; an
empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import fresh_name, row_key, written

SCOPE = 200
# The base patterns and the least lengths of their matches.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a match is as long as its run, so a shorter run has none
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
# The weak parts: what to match, and what a match must hold besides.
ID = r"[A-Z0-9]{16,}"
KEYS = r"[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{30,}[A-Za-z0-9+/_-]={0,2}"
#: Keys of the plain alphabet need no further capitals.
KEY = r"[A-Za-z0-9+/]{32,}={0,2}"
IS_ACCESS = f"^{ACCESS}$"
# A web address up to the values of its query, where keys may stand; one that names a user
# may hold a key anywhere.
URL = r"""https?://(?![^\s/?#:"'<>@]+(?::[^\s"'<>@]*)?@)[A-Za-z0-9._~%:/#+-]*(?:\?[^\s"'<>=&]*)?"""
# No address or host begins inside a run of such characters.
ENDPOINT = r"https?://[A-Za-z0-9.-]+|(?<![a-z0-9.-])[a-z0-9.-]+:[0-9]+"
IS_ENDPOINT = r"^https?://|[a-z0-9]\.[a-z0-9-]+:[0-9]{2,5}$"

KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
ROLES = ("secret", "id", "secret", "id", "secret", "endpoint")
NEEDS = {"id": ("secret",), "key": ("id", "endpoint"), "endpoint": ("secret",)}
_SPANS = "array<struct<start: int, kind: int, stop: int>>"


#: Parts of an array that are worked on at once; a part's part is as small.
BLOCK = 64


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(values: Column, size: int) -> Column:
    """An array that is not empty in parts of ``size``."""
    last = F.floor((F.size(values) - 1) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * size + 1, F.lit(size)))


def _running(values: Column, step, levels: int = 2) -> Column:
    """For each value of an array of numbers what ``step`` makes of all before it, from 0 on.

    An array that grows is copied at each step, so it grows in parts, whose own results are
    first made by parts of parts. The work is in proportion to the array.
    """

    def within(part: Column, first: Column) -> Column:
        begin = F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            part,
            begin,
            lambda s, v: F.struct(step(s["at"], v).cast("int").alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )

    if not levels:
        return within(values, F.lit(0))

    def joined(parts: Column) -> Column:
        whole = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda x, v: step(x, v).cast("int")))
        return F.flatten(F.zip_with(parts, _running(whole, step, levels - 1), within))

    return _with(_blocks(values, BLOCK), joined)


def _matches(pattern: str, kind: str, keep) -> Column:
    """Spans of the pattern's matches in column ``t`` for which ``keep`` holds.

    The matches and the pieces between them add up to the text, so that a running sum
    over their lengths gives the places.
    """
    both = F.zip_with(
        F.split("t", pattern, -1),
        F.regexp_extract_all("t", F.lit(pattern), F.lit(0)),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("long"), m.alias("m")),
    )

    def span(x: Column, at: Column) -> Column:
        start = at + x["gap"]
        made = F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + x["long"]).alias("stop")
        )
        return F.when(x["m"].isNotNull() & keep(x["m"]), made)

    def spans(found: Column) -> Column:
        places = _running(F.transform(found, lambda x: x["gap"] + x["long"]), lambda at, n: at + n)
        return F.array_compact(F.zip_with(found, places, span))

    return _with(both, spans).cast(_SPANS)


def _found(pattern: str, kind: str, keep=lambda m: F.lit(True), word: str = "", over: str = "") -> Column:
    """The matches, looked for in detail only in texts that have one.

    Where ``over`` matches first, it is passed over.
    """
    may = F.col("t").contains(word) if word else F.col("t").rlike(pattern)
    if over:
        skip, one = f"^(?:{over})$", keep
        pattern, keep = f"{over}|{pattern}", lambda m: ~m.rlike(skip) & one(m)
    return F.when(may, _matches(pattern, kind, keep)).otherwise(F.array().cast(_SPANS))


def _count(m: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(m, f"[^{characters}]", ""))


def _is_id(m: Column) -> Column:
    access = m.rlike(IS_ACCESS) & (F.length(m) >= ACCESS_LENGTH)
    return m.rlike("[A-Z]") & m.rlike("[0-9]") & ~access


def _is_key(m: Column) -> Column:
    """Whether a run is no name or path made of words, which have few capitals and no digits."""
    capitals, digits = _count(m, "A-Z"), m.rlike("[0-9]")
    mixed = (capitals * 4 >= F.length(m)) & (_count(m, "a-z") * 4 >= F.length(m))
    whole = m.rlike(KEY) | (capitals * 8 >= F.length(m))
    both = m.rlike("[a-z]") & m.rlike("[A-Z]") & (digits | mixed) & whole
    upper = m.rlike("^[A-Z0-9]+=*$") & m.rlike("[A-Z]") & digits & ~m.rlike(IS_ACCESS)
    return both | upper


def scan(docs: DataFrame, keep: Column, text_col: str = "text") -> DataFrame:
    """(kept, uid, base, weak) per row, written: spans as (start, kind number, stop)."""
    rows = docs.select(keep.alias("kept"), F.coalesce(f"`{text_col}`", F.lit("")).alias("t"))
    assign = f"(?i){ASSIGN}"
    base = [
        _found(
            assign,
            "assign",
            lambda m: F.length(F.regexp_extract(m, assign, 2)) >= ASSIGN_VALUE,
        ),
        _found(ACCESS, "access", lambda m: F.length(m) >= ACCESS_LENGTH, "AKIA"),
        _found(HEX, "hex"),
    ]
    weak = [
        _found(ID, "id", _is_id),
        _found(KEYS, "key", _is_key, over=URL),
        _found(ENDPOINT, "endpoint", lambda m: m.rlike(IS_ENDPOINT)),
    ]
    rows = rows.select("kept", F.concat(*base).alias("base"), F.concat(*weak).alias("weak"))
    # Written at once: the numbers stay the same from then on.
    return written(rows.withColumn("uid", F.monotonically_increasing_id()), "scan")


def linked(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(uid, added): the weak spans of each row that have a complement in their scope."""
    rows = scanned.where("size(weak) > 0")
    parts = rows.select("uid", F.explode(F.concat("base", "weak")).alias("s"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("s.kind") + 1)
    # The points where parts stop and start; a scope before or after a span is as long as a
    # cell, so it holds the begin or the end of each cell that it meets, or all of it.
    points = F.explode(F.array(*[F.struct(F.lit(x).alias("side"), F.col(f"s.{x}").alias("at")) for x in ("stop", "start")]))
    parts = parts.select("uid", role.alias("role"), points.alias("p"))
    parts = parts.groupBy("uid", "role", "p.side", F.expr(f"int(p.at / {scope})").alias("cell")).agg(
        F.min("p.at").alias("first"), F.max("p.at").alias("last")
    )
    weak = rows.select("uid", F.explode("weak").alias("s"))
    needs = F.array(*[F.array(*map(F.lit, NEEDS.get(k, ()))) .cast("array<string>") for k in KINDS])
    weak = weak.withColumn("role", F.explode(F.element_at(needs, F.col("s.kind") + 1)))
    sides = F.expr(
        f"""array(struct('stop' AS side, greatest(s.start - {scope}, 0) AS low, s.start - 1 AS high),
                  struct('start' AS side, s.stop + 1 AS low, s.stop + {scope} AS high))"""
    )
    weak = weak.withColumn("x", F.explode(sides)).select("uid", "s", "role", "x.*").where("low <= high")
    weak = weak.withColumn("cell", F.explode(F.expr(f"sequence(int(low / {scope}), int(high / {scope}))")))
    near = F.col("first").between(F.col("low"), F.col("high")) | F.col("last").between(F.col("low"), F.col("high"))
    found = weak.join(parts, ["uid", "role", "side", "cell"]).where(near).select("uid", "s").distinct()
    return found.groupBy("uid").agg(F.collect_list("s").alias("added"))


def secrets(docs: DataFrame, keep: Column, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(kept, base, spans) per row: base findings, and these with the linked parts, in order."""
    scanned = scan(docs, keep, text_col)
    rows = scanned.join(linked(scanned, scope), "uid", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(_SPANS))))
    return rows.select("kept", F.array_sort("base").alias("base"), spans.alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _pieces(text: Column, first: Column, cuts: Column, size: int) -> Column:
    """The pieces (a, b) of a text that begins at ``first``.

    To find a place in a text takes as long as the text before it, so pieces are taken from
    parts of the text, and these from larger parts.
    """
    if size == 1:
        return F.transform(cuts, lambda c: F.substring(text, c["a"] - first + 1, c["b"] - c["a"]))

    def part(block: Column) -> Column:
        a, b = F.get(block, F.lit(0))["a"], F.element_at(block, -1)["b"]
        return _with(F.substring(text, a - first + 1, b - a), lambda t: _pieces(t, a, block, size // BLOCK))

    return F.flatten(F.transform(_blocks(cuts, size), part))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of spans that overlap, replaced by ``mark``.

    ``spans`` come in order, and there is one at least.
    """

    def cut(spans: Column) -> Column:
        # A run of spans that overlap begins where no earlier one goes on.
        before = _running(F.transform(spans, lambda s: s["stop"]), lambda x, y: F.greatest(x, y))
        piece = lambda s, a: F.when(s["start"] >= a, F.struct(a.alias("a"), s["start"].alias("b")))
        end = F.array(F.struct(F.array_max(F.transform(spans, lambda s: s["stop"])).alias("a"), F.length(text).alias("b")))
        return F.concat(F.array_compact(F.zip_with(spans, before, piece)), end)

    pieces = _with(_with(spans, cut), lambda cuts: _pieces(text, F.lit(0), cuts, BLOCK * BLOCK))
    return F.array_join(pieces, mark)


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with the secrets in ``text`` marked out; ``n_chars`` follows the new text.

    Rows are matched by their id (or the whole row) and their text's hash.
    """
    name = fresh_name(docs, "key")
    keyed = docs.withColumn(name, F.struct(row_key(docs).alias("id"), F.xxhash64("text").alias("h")))
    found = secrets(keyed, F.col(name), scope=scope).where("size(spans) > 0")
    found = found.select(F.col("kept.id").alias("k"), F.col("kept.h").alias("h"), "spans")
    found = written(found.dropDuplicates(["k", "h"]), "secrets")
    spans = fresh_name(docs, "spans")
    found = found.withColumnRenamed("spans", spans)
    match = (F.col(f"{name}.id") == F.col("k")) & (F.col(f"{name}.h") == F.col("h"))
    new = fresh_name(docs, "new")
    changed = F.col(spans).isNotNull()
    rows = keyed.join(found, match, "left")
    # The new text has a name of its own until both columns that need it are made.
    rows = rows.withColumn(new, F.when(changed, redacted(F.col("text"), F.col(spans))))
    out = {"text": F.when(changed, F.col(new)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        chars = F.when(changed, F.length(new).cast("long"))
        out["n_chars"] = chars.otherwise(F.col("n_chars"))
    return rows.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def oracle(scope: int = SCOPE) -> str:
    """The same rules by DuckDB, comparing every weak span with every part of its document.

    Its patterns know no look-around: an address that names a user gets another sign for its
    colon before keys are looked for, and a host's character before it is looked at later.
    """
    user = r"""(https?):(//[^\s/?#:"'<>@]+(?::[^\s"'<>@]*)?@)"""
    url = URL.replace("""(?![^\\s/?#:"'<>@]+(?::[^\\s"'<>@]*)?@)""", "")
    quoted = {
        "assign": f"(?i){ASSIGN}",
        "access": ACCESS,
        "hex": HEX,
        "id": ID,
        "key": f"{url}|{KEYS}",
        "endpoint": ENDPOINT.replace("(?<![a-z0-9.-])", ""),
    }
    quoted = {k: "'" + p.replace("'", "''") + "'" for k, p in quoted.items()}
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    has = lambda p: f"regexp_matches(m, {quote(p)})"
    number = lambda c: f"length(regexp_replace(m, '[^{c}]', '', 'g'))"
    access = f"({has(IS_ACCESS)} AND length(m) >= {ACCESS_LENGTH})"
    mixed = f"({number('A-Z')} * 4 >= length(m) AND {number('a-z')} * 4 >= length(m))"
    whole = f"({has(KEY)} OR {number('A-Z')} * 8 >= length(m))"
    both = f"({has('[a-z]')} AND {has('[A-Z]')} AND ({has('[0-9]')} OR {mixed}) AND {whole})"
    upper = f"({has('^[A-Z0-9]+=*$')} AND {has('[A-Z]')} AND {has('[0-9]')} AND NOT {has(IS_ACCESS)})"
    keep = {
        "assign": f"length(regexp_extract(m, {quoted['assign']}, 2)) >= {ASSIGN_VALUE}",
        "access": f"length(m) >= {ACCESS_LENGTH}",
        "hex": "true",
        "id": f"{has('[A-Z]')} AND {has('[0-9]')} AND NOT {access}",
        "key": f"NOT {has(f'^(?:{url})$')} AND ({both} OR {upper})",
        "endpoint": f"{has(IS_ENDPOINT)} AND ({has('^https?://')} OR NOT regexp_matches(gap, '[a-z0-9.-]$'))",
    }
    parts = " UNION ALL ".join(
        f"""SELECT doc_id, {i} AS kind, start, start + length(m) AS stop
            FROM (SELECT doc_id, ms[i] AS m, concat(ms[i - 1], gaps[i]) AS gap,
                    coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
                    + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS start
                  FROM (SELECT doc_id, gaps, ms, unnest(range(1, len(ms) + 1)) AS i
                        FROM (SELECT doc_id, string_split_regex({'u' if k == 'key' else 't'}, {quoted[k]}) AS gaps,
                                     regexp_extract_all({'u' if k == 'key' else 't'}, {quoted[k]}, 0) AS ms FROM d))) WHERE {keep[k]}"""
        for i, k in enumerate(KINDS)
    )
    role = "CASE " + " ".join(f"WHEN kind = {i} THEN '{r}'" for i, r in enumerate(ROLES)) + " END"
    need = " OR ".join(
        f"w.kind = {KINDS.index(k)} AND p.role IN ({', '.join(repr(r) for r in roles)})"
        for k, roles in NEEDS.items()
    )
    name = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END"
    joined = f"string_agg({name} || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                regexp_replace(coalesce(text, ''), {quote(user)}, concat('\\1', chr(1), '\\2'), 'g') AS u FROM documents),
        parts AS (SELECT *, {role} AS role FROM ({parts})),
        kept AS (SELECT * FROM parts WHERE kind < 3 UNION ALL
          SELECT * FROM parts w WHERE kind >= 3 AND EXISTS (SELECT 1 FROM parts p
            WHERE p.doc_id = w.doc_id AND (p.start BETWEEN w.stop + 1 AND w.stop + {scope}
              OR p.stop BETWEEN w.start - {scope} AND w.start - 1) AND ({need}))),
        per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign,
                  count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                  {joined} FILTER (kind < 3) AS base, {joined} AS spans FROM kept GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
          coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
          coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (doc_id)"""
