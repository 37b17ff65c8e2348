"""Personal data (operator 3): bootstrapped contextual extraction.

1. One map over the texts finds the base spans (seed entities) by grammar, and
   beside them every occurrence that could be one or counts against it: tokens
   of a loosened shape (no plus sign, failing checksum, bare host, spelt-out at
   and dot, eight groups of hex), all other tokens with a digit, and whatever
   follows a label.  Long mixed values assigned in quotes are seeds of a kind of
   their own, ``secret``, which no base grammar has.
2. Each occurrence has lexical patterns in any script: the word before it, the
   two words before it, the word after it, with the signs between.  Spark builds
   the pattern-instance graph and scores it iteratively.  A pattern's confidence
   for a kind is the share of its occurrences, whatever they are, that its
   instances' confidences add up to; it holds from ``MIN_SEEDS`` distinct
   instances, seeds and promoted ones alike.  An instance's confidence is one
   for seeds, else the noisy-or of the patterns that hold; so what one pattern
   discovers supports the next.  The rounds end when none is promoted any more.
3. Patterns that hold turn their candidates into spans.  Base spans always stay;
   an added span that overlaps one, or an earlier added one, is dropped.

The texts are read once; what the map finds is written to the shared folder and
everything after it is joins on patterns and row numbers, pre-aggregated, so a
common word is no single task.  Nothing is cut: contexts and tokens above
``NAMED`` code points go by a hash of the whole.  Null and empty texts have no
spans.  Rows are told apart by a row number, so repeated and null ids keep their
own results.  Extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Scratch, documents, materialize

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only patterns find follow the base ones.
ALL_KINDS = (*KINDS, "secret")
#: Rounds that the iteration may take at most; it has ended before where a round promotes nothing.
ROUNDS = 8
#: Distinct instances a pattern needs, and the confidence from which it discovers.
MIN_SEEDS = 5
CONFIDENCE = 0.6
#: Words of a context, those of signs alone among them, that a pattern reaches over.
SIGNS = 8
#: Code points up to which a token or context stands for itself in the graph.
NAMED = 64

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_NUMBER = re.compile(r"(?<!\S)[^\s0-9]*[0-9]\S*")
_AT = re.compile(r"[ ]?(?:@|\(at\)|\[at\])[ ]?")
_HOST = re.compile(r"[\w-]+(?:(?:\.|[ ]?(?:\(dot\)|\[dot\])[ ]?)[\w-]+)*")
_LABEL = re.compile(r"(?<![^\W_])[^\W\d_][\w.-]*[ ]?[:=#][ ]?[\"'<]?(?=[^\s\"'<])")
_VALUE = re.compile(r"[^\s\"'<>,;]+")
_SECRET = re.compile(r"[A-Za-z0-9+/=_-]{16,}(?![\w])")
_LOOSE = (
    ("ip", re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")),
    ("phone", re.compile(r"(?<![\w.+-])\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![\w-]|\.[0-9])")),
    ("card", re.compile(r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])")),
)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's index, end) of the fixed grammars' matches, in order."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def _name(x: str) -> str:
    return x if len(x) <= NAMED else "#" + hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def _contexts(text: str, bounds: list[tuple[int, int]], starts: list[int], s: int, e: int) -> list[str]:
    """The patterns around text[s:e]: one and two words before it, one after it, and the signs between."""
    first, last = bisect_right(starts, s) - 1, bisect_right(starts, e - 1) - 1
    out, met, words = [], [], 0
    for k in range(first, max(first - SIGNS, -1), -1):
        part = text[bounds[k][0] : s if k == first else bounds[k][1]]
        met.append(part)
        if any(map(str.isalnum, part)):
            words += 1
            out.append(f"{words}<{_name(_DIGITS.sub('0', ' '.join(reversed(met)).lower()))}")
            if words == 2:
                break
    met = []
    for k in range(last, min(last + SIGNS, len(bounds))):
        part = text[e if k == last else bounds[k][0] : bounds[k][1]]
        met.append(part)
        if any(map(str.isalnum, part)):
            out.append(f"1>{_name(_DIGITS.sub('0', ' '.join(met).lower()))}")
            break
    return out


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple[str | None, str, bool, bool, int, int, list[str]]]:
    """(kind or None, token, is a seed, is a base span, start, end, patterns): base spans, candidates, and what counts against a pattern."""
    signs = ":" in text or "=" in text or "#" in text
    at = _AT.search(text)
    if not base and not at and not signs and not _DIGITS.search(text):
        return []
    taken = [(s, e, KINDS[k], True, True) for s, k, e in base]
    busy = bytearray(len(text))

    def free(s: int, e: int) -> bool:
        return not any(busy[s:e])

    def claim(s: int, e: int) -> None:
        busy[s:e] = b"\x01" * (e - s)

    for s, e, *_ in taken:
        claim(s, e)
    low = 0
    while at:
        s = at.start()
        while s > low and (text[s - 1].isalnum() or text[s - 1] in "._%+-"):
            s -= 1
        host = _HOST.match(text, at.end())
        low = at.end()
        if s < at.start() and host and free(s, host.end()):
            taken.append((s, host.end(), "email", False, False))
            claim(s, host.end())
            low = host.end()
        at = _AT.search(text, low)
    for kind, shape in _LOOSE:
        for m in shape.finditer(text):
            if free(*m.span()):
                taken.append((*m.span(), kind, False, False))
                claim(*m.span())
    if signs:
        for m in _LABEL.finditer(text):
            v = _VALUE.match(text, m.end())
            if v and free(*v.span()):
                secret = _SECRET.match(text, m.end())
                value = secret.group() if secret else ""
                digits = sum(map(str.isdigit, value))
                mixed = 0 < digits < len(value)
                sure = mixed and len(value) >= 32 and 6 <= digits <= len(value) - 6 and text[m.end() - 1] in "\"'"
                span = secret.span() if mixed else v.span()
                taken.append((*span, "secret" if mixed else None, sure, False))
                claim(*span)
    for m in _NUMBER.finditer(text):
        if free(*m.span()):
            taken.append((*m.span(), None, False, False))
    bounds = [m.span() for m in _WORD.finditer(text)]
    starts = [s for s, _ in bounds]
    return [(kind, _name(text[s:e]), seed, fixed, s, e, _contexts(text, bounds, starts, s, e)) for s, e, kind, seed, fixed in taken]


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_FOUND = (
    "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string,"
    " cues array<struct<kind:string,token:string,seed:boolean,base:boolean,start:long,end:long,contexts:array<string>>>"
)
_CUE = [("kind", pa.string()), ("token", pa.string()), ("seed", pa.bool_()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("contexts", pa.list_(pa.string()))]
_CUES = pa.list_(pa.struct(_CUE))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 36
    names = [n for n, _ in _CUE]
    for batch in batches:
        ids, counts, lines, hashes, cues = batch.column("doc_id"), [], [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            counts.append([sum(k == n for _, k, _ in base) for n in range(4)])
            lines.append(_line(base))
            hashes.append(hashlib.sha256(lines[-1].encode()).hexdigest())
            cues.append([dict(zip(names, x)) for x in occurrences(text, base)])
        n = len(ids)
        columns = [pa.array(range(row, row + n), pa.int64()), ids, *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4))]
        columns += [pa.array(hashes, pa.string()), pa.array(lines, pa.string()), pa.array(cues, _CUES)]
        row += n
        yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "cues"])


def patterns(cues: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """(context, kind, support, conf) of the patterns that hold, from (kind, token, seed, contexts); a stored table."""
    with Scratch() as s:
        met = cues.select("kind", "token", "seed", F.explode(F.array_distinct("contexts")).alias("context"))
        every = met.groupBy("context").agg(F.count("*").alias("total"))
        seen = met.where(F.col("kind").isNotNull()).groupBy("context", "kind", "token").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
        # a token that is a seed anywhere is one everywhere
        known = seen.groupBy("kind", "token").agg(F.max("seed").alias("known"))
        edges = s.store(seen.drop("seed").join(known, ["kind", "token"]).join(every, "context"), "pii-graph")
        scored, before, good = edges.withColumn("conf", F.col("known").cast("double")), -1, None
        for _ in range(rounds):
            support = F.sum(F.when(F.col("conf") >= confidence, 1).otherwise(0))
            pattern = scored.groupBy("context", "kind").agg(support.alias("support"), (F.sum(F.col("n") * F.col("conf")) / F.max("total")).alias("conf"))
            good = s.store(pattern.where((F.col("support") >= min_seeds) & (F.col("conf") >= confidence)), "pii-patterns")
            doubt = F.exp(F.sum(F.log1p(-F.least(F.col("conf"), F.lit(0.999)))))
            promoted = edges.where("not known").join(good, ["context", "kind"]).groupBy("kind", "token").agg((1 - doubt).alias("noisy"))
            promoted = s.store(promoted, "pii-promoted")
            now = promoted.count()
            if now == before:
                break
            before = now
            scored = edges.join(promoted, ["kind", "token"], "left").withColumn("conf", F.when(F.col("known"), 1.0).otherwise(F.coalesce("noisy", F.lit(0.0))))
        return s.keep(good)


def find_pii(docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """Base counts and hash, all spans, how many they are (``n_spans``) and how many of them the patterns added (``n_added``)."""
    found = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, _FOUND), "pii-found")
    cues = found.where(F.size("cues") > 0).select("row", F.explode("cues").alias("c")).select("row", "c.*")
    good = patterns(cues, rounds, min_seeds, confidence)
    kinds = F.array(*map(F.lit, ALL_KINDS))
    index = F.array_position(kinds, F.col("kind")).cast("int")
    span = "array<struct<start:bigint,kind:int,end:bigint>>"
    added = (
        cues.where(F.col("kind").isNotNull() & ~F.col("base"))
        .select("row", "kind", "start", "end", F.explode("contexts").alias("context"))
        .join(good.select("context", "kind"), ["context", "kind"])
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("start", index.alias("kind"), "end"))).alias("more"))
    )
    parsed = F.when(F.col("base") == "", F.array().cast(span)).otherwise(
        F.transform(
            F.split("base", ","),
            lambda x: F.struct(
                F.split(x, ":")[1].cast("long").alias("start"),
                F.array_position(kinds, F.split(x, ":")[0]).cast("int").alias("kind"),
                F.split(x, ":")[2].cast("long").alias("end"),
            ),
        )
    )
    clash = lambda x, spans: F.exists(spans, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    kept = F.aggregate(F.coalesce("more", F.array().cast(span)), F.col("spans_in"), lambda acc, x: F.when(clash(x, acc), acc).otherwise(F.concat(acc, F.array(x))))
    text = lambda spans: F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"]), x["start"], x["end"])), ",")
    base_spans_in = sum((F.col(f"n_{k}") for k in KINDS), F.lit(0))
    n_added = F.when(F.col("more").isNull(), F.lit(0)).otherwise(F.size("spans_out") - F.size("spans_in")).cast("long")
    return (
        found.drop("cues")
        .join(added, "row", "left")
        .withColumn("spans_in", F.when(F.col("more").isNotNull(), parsed))
        .withColumn("spans_out", F.when(F.col("more").isNotNull(), kept))
        .select(
            "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
            F.when(F.col("more").isNull(), F.col("base")).otherwise(text(F.col("spans_out"))).alias("spans"),
            n_added.alias("n_added"),
            (base_spans_in + n_added).cast("long").alias("n_spans"),
        )
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))
