"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Base finds are the seeds. The words around them are lexical patterns (two words before; one before and one
after; backing off, one word with the shape of the identifier, its digits, letters and punctuation). Every identifier-like token of the corpus is an instance. Spark scores the bipartite graph of
patterns and instances in rounds: a pattern's confidence in a kind is the share of its instances that are
believed to be of that kind, an instance's confidence is the chance that not all of its patterns err.
Instances that confident patterns agree on become spans, wherever the token occurs. Edges are distinct
(pattern, instance) pairs, combined before the shuffle, so copies of a document count once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlab.llm.storage import forget, ready, stored, without

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: seeds (distinct strings) that a pattern needs, its least confidence, and that of a found instance
SUPPORT, TRUST, SURE = 3, 0.6, 0.75

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive runs and the look-behind only save work: a match never starts inside a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACES = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NAME = re.compile(r"[A-Za-z_-]+[=:]")
_NUMBER = re.compile(r"[0-9().+-]+")
_OPEN, _CLOSE = "([{<\"'", ".,;:!?)]}>\"'"

_SPAN = "struct<kind: int, start: int, end: int>"
_SCHEMA = (
    f"base array<{_SPAN}>, "
    "seeds array<struct<kind: int, literal: string, patterns: array<string>>>, "
    "instances array<struct<start: int, end: int, literal: string, patterns: array<string>>>"
)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        got = _DOMAIN.match(text, at) if start < at else None
        if got:
            free = got.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and not overlapping within a kind."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not _MARK.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def _identifiers(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an at sign outside the taken spans, without a name in front (`host=`) and trimmed of
    punctuation (a bracket that closes inside stays); number tokens one space apart are one."""
    at, k = 0, 0
    while got := _MARK.search(text, at):
        start = got.start()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] <= start:
            at = taken[k][1]
            continue
        floor = max(at, taken[k - 1][1] if k else 0)
        while start > floor and text[start - 1] not in _SPACES:
            start -= 1
        end = _WORD.match(text, start).end()
        ceiling = taken[k][0] if k < len(taken) else len(text)
        while _NUMBER.fullmatch(text, start, end) and text[end : end + 1] == " ":
            more = _NUMBER.match(text, end + 1)
            if not more or text[more.end() : more.end() + 1].strip(_SPACES):
                break
            end = more.end()
        end = min(end, ceiling)
        at = max(end, got.end())
        named = _NAME.match(text, start, end)
        start = named.end() if named and named.end() < end else start
        while start < end and text[start] in _OPEN and not (text[start] == "(" and text.find(")", start, end - 1) > 0):
            start += 1
        while start < end and text[end - 1] in _CLOSE:
            end -= 1
        if start < end:
            yield start, end


def _word_before(text: str, at: int) -> tuple[str, int]:
    """The whole word that ends before `at` (spaces between are passed), and its start; at the text's edge "^"."""
    while at > 0 and text[at - 1] in _SPACES:
        at -= 1
    end = at
    while at > 0 and text[at - 1] not in _SPACES:
        at -= 1
    return (_context_word(text[at:end]) if at < end else "^"), at


def _context_word(word: str) -> str:
    """Lower case, digits as 0; of the punctuation around it only a mark that introduces something stays. A word of more
    than 64 characters stands as its digest."""
    core = word.lower().strip(_OPEN + _CLOSE)
    core = re.sub("[0-9]+", "0", core)
    core = core if len(core) <= 64 else hashlib.md5(core.encode()).hexdigest()
    return core + word[-1] if word[-1] in ":=#" and not core.endswith(word[-1]) else core


def _shape(literal: str) -> str:
    """Runs of digits as 0, of letters as a, of anything else that is not punctuation as w; at most 32 characters."""
    return re.sub(r"[^\x00-\x7f]+", "w", re.sub("[a-z]+", "a", re.sub("[0-9]+", "0", literal)))[:32]


def _around(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span, from the most particular: two words before; the word before and the one after; and,
    backing off, one word before or after, or the second word before, with the span's shape. Words are whole."""
    one, at = _word_before(text, start)
    two, _ = _word_before(text, at)
    after = _WORD.search(text, end) if end < len(text) else None
    if after and after.start() == end:  # what the span's own token goes on with
        after = _WORD.search(text, after.end())
    right = _context_word(after.group()) if after else "$"
    shape = _shape(_literal(text, start, end))
    found = [f"{two} {one} _", f"{one} _ {right}", f"{one} _ :{shape}", f"_ {right} :{shape}", f"{two} * _ :{shape}"]
    # the edges of a text alone say nothing
    edges = ("^ ^ _", "^ _ $", f"^ _ :{shape}", f"_ $ :{shape}", f"^ * _ :{shape}")
    return [x for x, edge in zip(found, edges) if x != edge]


def _literal(text: str, start: int, end: int) -> str:
    return text[start:end].lower()


def _scan(docs: DataFrame, text_col: str) -> DataFrame:
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != text_col)

    def read(text: str) -> tuple[list, list, list]:
        base = base_spans(text)
        seeds = [(k, _literal(text, a, b), _around(text, a, b)) for k, a, b in base]
        taken: list[tuple[int, int]] = []
        for _, a, b in sorted(base, key=lambda s: s[1:]):
            if taken and a <= taken[-1][1]:
                taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
            else:
                taken.append((a, b))
        found = [(a, b, _literal(text, a, b), _around(text, a, b)) for a, b in _identifiers(text, taken)]
        return base, seeds, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [read(t or "") for t in batch[text_col].to_pylist()]
            span = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
            seed = [("kind", pa.int32()), ("literal", pa.string()), ("patterns", pa.list_(pa.string()))]
            instance = [*span[1:], *seed[1:]]
            out = batch.drop_columns([text_col])
            for k, (name, kind) in enumerate((("base", span), ("seeds", seed), ("instances", instance))):
                rows = [[dict(zip((n for n, _ in kind), x)) for x in g[k]] for g in got]
                out = out.append_column(name, pa.array(rows, type=pa.list_(pa.struct(kind))))
            yield out

    return docs.mapInArrow(run, f"{fields}, {_SCHEMA}")


def _shape_allows() -> Column:
    """Kinds a token could be at all: an at sign, two separators, or enough digits."""
    text = F.col("literal")
    digits = F.char_length(F.regexp_replace(text, "[^0-9]", ""))
    parts = F.char_length(F.regexp_replace(text, "[^.:]", ""))
    return (
        F.when(F.col("kind") == 0, F.contains(text, F.lit("@")))
        .when(F.col("kind") == 1, (parts >= 2) & (digits >= 2))
        .when(F.col("kind") == 2, digits >= 12)
        .otherwise(digits >= 6)
    )


def discovered(scan: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """literal, kind of the instances that confident patterns agree on."""
    seeds = scan.select(F.explode("seeds").alias("s")).select(
        F.explode("s.patterns").alias("pattern"), "s.literal", "s.kind"
    )
    others = scan.select(F.explode("instances").alias("s")).select(
        F.explode("s.patterns").alias("pattern"), "s.literal"
    )
    seeds = stored(seeds.distinct(), "seed_edges")
    # only patterns that some seed induced matter; their instances are the graph
    others = stored(
        others.distinct().join(seeds.select("pattern").distinct(), "pattern", "left_semi"), "instance_edges"
    )
    share = seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    size = seeds.select("pattern", "literal").unionByName(others).distinct()
    size = size.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    patterns = stored(share.where(F.col("seeds") >= SUPPORT).join(size, "pattern"), "patterns")
    belief, spent = None, [seeds, others, patterns]
    for _ in range(rounds):
        scored = patterns.withColumn("mass", F.col("seeds").cast("double"))
        if belief is not None:
            more = others.join(belief, "literal").groupBy("pattern", "kind").agg(F.sum("belief").alias("more"))
            scored = patterns.join(more, ["pattern", "kind"], "left").withColumn(
                "mass", F.col("seeds") + F.coalesce("more", F.lit(0.0))
            )
        trust = scored.withColumn("trust", F.col("mass") / (F.col("size") + 1)).where(F.col("trust") >= TRUST)
        doubt = F.sum(F.log1p(-F.least(F.col("trust"), F.lit(0.999))))
        voted = others.join(trust.select("pattern", "kind", "trust"), "pattern")
        voted = voted.groupBy("literal", "kind").agg((1 - F.exp(doubt)).alias("belief"))
        belief = stored(voted.where(_shape_allows()), "beliefs")
        spent.append(belief)
    best = belief.where(F.col("belief") >= SURE).groupBy("literal").agg(
        F.max_by("kind", F.struct("belief", -F.col("kind"))).alias("kind")
    )
    best = stored(best, "found_identifiers")
    forget(*spent)
    return best


def find_private(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The documents' columns but the text, and base and spans: arrays of (kind number in KINDS, start, end) in
    code points, ordered by kind and start. spans holds base and the discovered ones.

    NULL and empty texts have no spans. Every row is read for itself, so repeated rows, NULL ids and ties
    keep all their rows. Input columns named like a result are replaced."""
    ready(docs.sparkSession)
    rows = without(docs, "base", "spans", "seeds", "instances", "_row")
    names = [c for c in rows.columns if c != text_col]
    scan = stored(_scan(rows, text_col).withColumn("_row", F.monotonically_increasing_id()), "pii_scan")
    extra = _places(scan, discovered(scan, rounds), "_row")
    none = F.array().cast(f"array<{_SPAN}>")
    spans = F.array_sort(F.concat("base", F.coalesce("extra", none)))
    found = scan.join(extra, "_row", "left").select(*names, F.array_sort("base").alias("base"), spans.alias("spans"))
    out = stored(found, "private_spans")
    forget(scan)
    return out


def _places(scan: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """key, extra: where the discovered identifiers stand."""
    places = scan.select(key, F.explode("instances").alias("i"))
    places = places.select(key, "i.start", "i.end", F.col("i.literal").alias("literal")).distinct()
    return places.join(known, "literal").groupBy(key).agg(F.collect_list(F.struct("kind", "start", "end")).alias("extra"))


def redact_private(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The documents, all columns, with every span of their texts (overlapping ones as one) replaced by its
    kind in brackets; see find_private. NULL texts stay NULL.

    Only places of discovered identifiers are joined to the texts, by a 128-bit digest of the text."""
    ready(docs.sparkSession)
    names = docs.columns
    rows = without(docs, "_pii_print", "_pii_extra").withColumn("_pii_print", F.md5(text_col))
    scan = stored(_scan(rows.select("_pii_print", text_col), text_col), "pii_scan")
    extra = _places(scan, discovered(scan, rounds), "_pii_print").withColumnRenamed("extra", "_pii_extra")
    extra = stored(extra, "pii_places")
    forget(scan)
    joined = rows.join(extra, "_pii_print", "left").drop("_pii_print")

    def cover(text: str | None, marks: list[dict] | None) -> str | None:
        if not text:
            return text
        spans = [*base_spans(text), *[(m["kind"], m["start"], m["end"]) for m in marks or ()]]
        out, at = [], 0
        for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cover(t, m) for t, m in zip(batch[text_col].to_pylist(), batch["_pii_extra"].to_pylist())]
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, text_col, pa.array(texts, type=pa.string())).drop_columns(["_pii_extra"])

    plain = joined.drop("_pii_extra")
    return joined.mapInArrow(run, plain.schema).select(*[c for c in names if c in plain.columns])


def span_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
