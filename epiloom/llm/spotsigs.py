"""Spot signatures: chains of content words behind common words as the fingerprint of a text.

Where a common word stands, it and the next CHAIN words that are not common form a
signature (SpotSigs: Theobald, Siddharth and Paepcke, 2008). As some texts, such as
tables, have hardly any common words, one word in eight, by its letters, begins
a chain as well, in every text alike. Texts with fewer than LEAST chains take a
chain, as long as the text allows, from every word.

Two sets can only be alike by at least t if their lengths fall into the same or
neighbouring classes of ratio t; others are not compared, and a comparison stops as
soon as t is out of reach (`jaccard`).

Nulls and odd rows: a null text is empty; a text without words has one
signature, of the text itself, so that equal texts have equal fingerprints and
two empty texts are alike by 1; documents of equal id follow each other by a
hash of their text, then by the text; null ids come last.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored
from epiloom.llm.hyperminhash import in_buckets, link_members, named_components, numbered_classes, parities, registers

CHAIN = 3
LEAST = 4
#: Common words of English, German, French and Spanish.
COMMON = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were "
    "all her she there would their we him been has when who will no more if out so up said what its about than into them can only "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er hat aus bei einer nach wie um am sind "
    "le la les de des du un une et est en que qui dans pour par sur avec pas au il elle ce se plus ne ou son sa aux "
    "el los las y del al por con para se una su como más pero sus lo ha no o es".split()
)
_WORD = re.compile(r"[^\W_]+")


def _hash(words: str) -> int:
    return xxhash.xxh64_intdigest(words) & 0xFFFFFFFF


def _chains(text: str) -> set[str]:
    """The chains of a text, as words; never empty."""
    words = _WORD.findall(text.lower())
    content: list[str] = []
    anchors: list[tuple[str, int]] = []
    common = COMMON
    for w in words:
        if w in common:
            anchors.append((w, len(content)))
        else:
            content.append(w)
            if not (31 * ord(w[0]) + ord(w[-1]) + len(w)) & 7:
                anchors.append((w, len(content)))
    most = len(content) - CHAIN
    found = {" ".join((w, *content[c : c + CHAIN])) for w, c in anchors if c <= most}
    if len(found) < LEAST:
        found |= {" ".join(words[i : i + CHAIN + 1]) for i in range(len(words))}
    return found or {text}


def signatures(text: str) -> np.ndarray:
    """The set of signatures, sorted, as 32-bit numbers; never empty."""
    return np.array(sorted({_hash(c) for c in _chains(text)}), "<u4")


def fingerprint(found: np.ndarray) -> str:
    return base64.b64encode(found.tobytes()).decode()


def length_class(n: int, least: float) -> int:
    """Sets that are alike by `least` or more are in one class or in neighbouring ones."""
    return int(math.log(n) / -math.log(least) + 1e-9)


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Likeness of two sorted sets; 0 if it is below `least`, found as early as lengths or parts of the sets show it."""
    if least > 0 and abs(length_class(len(a), least) - length_class(len(b), least)) > 1:
        return 0.0
    both = len(a) + len(b)
    need = math.ceil(least / (1 + least) * both - 1e-9)  # how many must be common
    if min(len(a), len(b)) < need:
        return 0.0
    common, at, step = 0, 0, 256
    while at < len(a):
        part = a[at : at + step]
        places = np.searchsorted(b, part)
        common += int((b[np.minimum(places, len(b) - 1)] == part).sum())
        at += step
        if common + max(0, len(a) - at) < need:
            return 0.0
    likeness = common / (both - common)
    return likeness if likeness >= least else 0.0


_PRINT = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("registers", pa.binary()), ("parity", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64()))]
)
_PRINT_DDL = "doc_id long, n long, digest binary, registers binary, parity array<long>, hashes array<long>"


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_signatures, component_id and kept, of each document: linked are those whose signatures have a Jaccard of percent / 100.

    Documents with equal signatures are one class. A class of length n shows its rarest
    n - ceil(n * percent / 100) + 1 signatures, in its own length class and in the next one: two
    sets that are alike share one of them in the class of the longer. Classes that share one are
    linked as in `hyperminhash`, so groups of copies of any size make no pairs of all with all.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                found = np.unique(np.array([xxhash.xxh64_intdigest(c) for c in _chains(text)], np.uint64))
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                yield doc_id, len(found), digest, registers(found).tobytes(), parities(found).tolist(), found.view(np.int64).tolist()

        return in_batches(rows(), _PRINT, 500)

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    prints = stored(texts.mapInArrow(read, _PRINT_DDL), "spot-prints")
    classes = numbered_classes(prints.where("doc_id IS NOT NULL"), ["n", "registers", "parity", "hashes"])
    single = classes.select("node", "n", F.explode("hashes").alias("signature"))
    counts = single.groupBy("signature").count()
    shown = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    rarest = F.row_number().over(Window.partitionBy("node").orderBy("count", "signature"))
    prefix = single.join(counts, "signature").withColumn("rank", rarest).where(F.col("rank") <= shown)
    length = F.floor(F.log("n") / -math.log(percent / 100) + 1e-9)
    both = F.explode(F.array(length, length + 1)).alias("length")
    keys = prefix.select("signature", "node", both).select(F.xxhash64("length", "signature").alias("key"), "node")
    sets = F.array_join(F.transform("hashes", lambda h: F.lpad(F.hex(h), 16, "0")), "")
    # hex() writes the high byte first; numpy reads the sets as they are, so order is all that must hold.
    full = classes.select("node", F.unhex(sets).alias("hashes"))
    linked = link_members(in_buckets(keys), classes.drop("hashes"), stored(full, "spot-sets"), percent)
    of_digest = named_components(classes, stored(linked, "spot-components"))
    of_digest = stored(of_digest.select("digest", F.col("component_id").alias("c")), "spot-of-digest")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return prints.join(of_digest, "digest", "left").select(
        "doc_id", F.col("n").alias("n_signatures"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the next."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_ROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text, peek: documents by descending id over partitions, each with the first of the next one behind it (peek).

    Partitions begin at ids taken from the table, so a document that begins one is known from
    its id and is sent to two. The first document of all follows the last.
    """
    ids = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*(F.lit(i / n) for i in range(1, n))) if n > 1 else F.array(F.lit(1.0))
    found = ids.agg(F.max("doc_id").alias("top"), F.approx_percentile("doc_id", shares, 100 * n).alias("inner")).first()
    starts = sorted({x for x in (found.top, *(found.inner or [])) if x is not None}, reverse=True)
    parts = max(1, len(starts))
    # A document's partition is the last one that begins at its id or above; null ids come behind all.
    begins = F.array(*map(F.lit, starts)).cast("array<long>")
    above = F.size(F.filter(begins, lambda s: s >= F.col("doc_id")))
    own = F.when(F.col("doc_id").isNull(), parts - 1).otherwise(above - 1)
    first = F.array_contains(begins, F.col("doc_id")) if starts else F.lit(True)
    here = F.struct(own.alias("part"), F.lit(False).alias("peek"))
    ahead = F.struct(F.pmod(own - 1, F.lit(parts)).alias("part"), F.lit(True).alias("peek"))
    targets = F.when(F.coalesce(first, F.lit(False)), F.array(here, ahead)).otherwise(F.array(here))
    dealt = ids.select("doc_id", "text", F.inline(targets)).repartitionById(parts, F.col("part").cast("int"))
    return dealt.sortWithinPartitions("peek", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text").select("doc_id", "text", "peek")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike it is to that and to the next document."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last: tuple | None = None
            done = False  # behind the first peeked row
            for doc_id, text, peek in rows_of(batches, "doc_id", "text", "peek"):
                if done:
                    continue
                own = signatures(text)
                if last is not None:
                    before_id, before, found = last
                    changed = edited(before, text)
                    other = signatures(changed)
                    digest = hashlib.sha256(changed.encode()).hexdigest()
                    yield before_id, len(before), digest, fingerprint(found), fingerprint(other), jaccard(found, other), jaccard(found, own)
                done = peek
                last = doc_id, text, own

        return in_batches(rows(), _ROW, 500)

    return in_ranges(docs).mapInArrow(compare, _DDL)
