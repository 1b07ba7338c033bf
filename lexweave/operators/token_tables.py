"""Token streams: global positions, splits, windows, samples, batches and the token cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import CACHE_VERSION, INT32_VOCAB, SPECIAL_TOKENS, UINT16_VOCAB
from ..functions.text import (
    hex_to_long,
    is_blank,
    line_chunk,
    normalize_text,
    story_chunk,
    uniform_draw,
)
from ..functions.tokens import byte_ids, byte_token_count
from ..session import materialize
from ..sources import sinks
from .encoding import byte_ids_of, encode_corpus
from .ordering import ID_SHIFTS, running_before
from .skew import with_facts
from .vocabulary import Vocabulary

#: Deltas that a token cache takes before it is written whole.
MAX_DELTAS = 8
EMPTY_CACHE = "the corpus has no story to encode"


def story_tokens(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """``key, ids, n_tokens`` of the exported form of every non-empty story."""
    chunks = docs.filter(~is_blank(F.col("text"))).select(
        key, story_chunk(normalize_text(F.col("text"))).alias("text")
    )
    if not vocabulary.merges:
        # counted apart from the array, so plans that need only lengths never build it
        return chunks.select(
            key,
            byte_ids(F.col("text")).alias("ids"),
            byte_token_count(F.col("text")).cast("bigint").alias("n_tokens"),
        )
    return with_counts(encode_corpus(chunks, vocabulary, key))


def story_offsets(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """``token_offsets(story_tokens(...))`` for whole corpora: ``key, ids, n_tokens, start_pos``.

    Texts are stored with their lengths and a number; lengths alone are placed, and the texts,
    which no window or sort ever holds, meet their positions once and become ids only then.
    """
    if vocabulary.merges:
        return _placed(story_tokens(docs, vocabulary, key), key, "story-tokens")
    text = F.col("text")
    chunks = docs.filter(~is_blank(text)).select(key, story_chunk(normalize_text(text)).alias("text"))
    placed = _placed(chunks.withColumn("n_tokens", byte_token_count(text).cast("bigint")), key, "story-chunks")
    return placed.select(key, byte_ids_of(text).alias("ids"), "n_tokens", "start_pos")


def _placed(table: DataFrame, key: str, label: str) -> DataFrame:
    """``token_offsets(table)`` of wide rows, stored first; only their lengths are ordered."""
    stored = materialize(table.withColumn("__row", F.monotonically_increasing_id()), label)
    places = token_offsets(stored.select(key, "__row", "n_tokens"), key).select("__row", "start_pos")
    return with_facts(stored, places, "__row").drop("__row")


def line_blocks(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Raw lines as ``key, text`` rows that encode to the same ids as the joined text.

    A run of white space between two lines is cut before its last character, where
    pre-tokens always end: that character opens the next row, the rest closes this one.
    Blank lines join the line before them. A special token ends the run before it, so
    the run then stays whole.
    """
    lead = "(?U)\\A[\\s\\x1c-\\x1f]*"
    special = "\\A(?:" + "|".join(SPECIAL_TOKENS) + ")"
    text = F.col("text")
    solid = (~is_blank(text)).cast("bigint")
    chunks = lines.select(key, line_chunk(text).alias("text"), solid.alias("solid"))
    placed = running_before(chunks, key, F.col("solid"), "seen")
    blocks = placed.groupBy((F.col("seen") + F.col("solid")).alias("block")).agg(
        F.min(key).alias(key),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(key, "text"))), lambda x: x["text"]), ""
        ).alias("text"),
    )
    blocks = blocks.withColumn("lead", F.regexp_extract("text", lead, 0)).withColumn(
        "rest", F.substring(F.col("text"), F.length("lead") + 1, F.length("text"))
    )
    opens = ~F.rlike("rest", F.lit(special))  # takes the last blank of the run before it
    following = blocks.select(
        (F.col("block") - 1).alias("block"), F.col("lead").alias("next_lead"), opens.alias("next_opens")
    )
    first = blocks.agg(F.min("block")).scalar()
    # the line before ends with a newline, which is the last blank when there is no lead
    last_blank = F.when(F.length("lead") > 0, F.substring("lead", -1, 1)).otherwise("\n")
    prefix = F.when(F.col("block") == first, F.col("lead")).when(opens, last_blank).otherwise("")
    joined = blocks.join(following, "block", "left")
    whole = F.concat(prefix, F.col("rest"), F.coalesce("next_lead", F.lit("")))
    kept = F.when(F.col("next_opens"), F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    return joined.select(key, kept.alias("text"))


def with_counts(encoded: DataFrame) -> DataFrame:
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


def token_offsets(
    table: DataFrame, key: str = "doc_id", size: str = "n_tokens", shifts=ID_SHIFTS
) -> DataFrame:
    """Add ``start_pos``, the position of a row's first token in the whole stream.

    The sizes are read twice (bucket totals, then rows): give it a stored table, or
    lengths that are cheap to compute.
    """
    placed = running_before(table, key, F.col(size), "start_pos", shifts=shifts)
    return placed.withColumn("start_pos", F.col("start_pos").cast("bigint"))


def stream_length(offsets: DataFrame, size: str = "n_tokens") -> Column:
    """Tokens of the stream as a scalar subquery."""
    return offsets.agg(F.coalesce(F.sum(size), F.lit(0)).cast("bigint")).scalar()


def contiguous_split(
    offsets: DataFrame, train_fraction: float, key: str = "doc_id"
) -> DataFrame:
    """Cut the stream at ``floor(N * fraction)``; a row across the cut gives two pieces.

    ``split, from_pos, n_tokens, first`` with ``first`` the offset inside the row.
    """
    if not 0.0 < train_fraction < 1.0:
        raise ValueError("train_fraction must lie between 0 and 1")
    cut = F.floor(stream_length(offsets) * F.lit(float(train_fraction))).cast("bigint")
    rows = offsets.withColumn("cut", cut)
    start, end = F.col("start_pos"), F.col("start_pos") + F.col("n_tokens")
    left = F.least(end, F.col("cut")) - start
    right = end - F.greatest(start, F.col("cut"))
    pieces = F.array(
        F.struct(F.lit("train").alias("split"), F.lit(0).cast("bigint").alias("first"), left.alias("n")),
        F.struct(F.lit("validation").alias("split"), F.greatest(F.lit(0).cast("bigint"), left).alias("first"), right.alias("n")),
    )
    keep = [c for c in offsets.columns if c not in ("n_tokens", "start_pos", "ids")]
    ids = ["ids"] if "ids" in offsets.columns else []
    cut_rows = rows.select(
        *keep, *ids, "start_pos", F.explode(F.filter(pieces, lambda p: p["n"] > 0)).alias("p")
    )
    out = [
        *keep,
        F.col("p.split").alias("split"),
        (F.col("start_pos") + F.col("p.first")).alias("from_pos"),
        F.col("p.n").alias("n_tokens"),
        F.col("p.first").alias("first"),
    ]
    if ids:
        out.append(
            F.slice("ids", (F.col("p.first") + 1).cast("int"), F.col("p.n").cast("int")).alias("ids")
        )
    return cut_rows.select(*out)


def require_longer_than(offsets: DataFrame, block_size: int) -> int:
    """Fail when the stream is too short for a single shifted window."""
    total = offsets.agg(F.sum("n_tokens")).first()[0] or 0
    if total <= block_size:
        raise ValueError(f"split has {total} tokens but needs more than {block_size}")
    return total


def _collect_pieces(pieces: DataFrame, *keys: str) -> DataFrame:
    """Join slices of one span back together; a span holds a bounded number of tokens."""
    return pieces.groupBy(*keys).agg(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]
            )
        ).alias("tokens")
    )


#: Tokens that spans of a whole stream travel in, so that what they share is sent once.
REACH = 16_384


def spans(
    offsets: DataFrame, first: Column, last: Column, begin, end, name: str, *, together: int = 1,
    same: tuple[str, ...] = (),
) -> DataFrame:
    """Tokens of numbered spans of the stream.

    ``first``/``last`` give the numbers of the spans a row touches; ``begin(k)`` and
    ``end(k)`` give the half-open position range of span ``k``, both rising with ``k``. Each
    row sends one slice per span, so no per-token rows exist, and a span's slices meet in one
    group. In a stream without gaps, with ``together`` above one, spans that lie in one row are cut
    where the row is, and only the others are sent; ``together`` neighbours share a group, so
    tokens that they share are sent once. ``same`` names columns with one value for all rows that
    ``begin`` and ``end`` read.
    """
    if together > 1:
        rows = _touching(offsets, first, last, begin, end, same)
        whole = rows.select(*same, F.explode(_reaches(_whole_runs(begin, end), begin, end, together)).alias("r"))
        numbers = F.sequence("r.low", "r.high")
        held = _cut_spans(whole.select(*same, "r.at", F.col("r.piece").alias("tokens"), numbers.alias("numbers")), begin, end, name, same)
        return held.unionByName(_cut_spans(_shared(rows, begin, end, together, same), begin, end, name, same))
    return _collect_pieces(_slices(offsets, first, last, begin, end, name, same), name, *same)


def _slices(
    offsets: DataFrame, first: Column, last: Column, begin, end, name: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``keep, name, at, piece``: what each row holds of the spans it touches."""
    start = F.col("start_pos")
    stop = start + F.col("n_tokens")

    def piece(k: Column) -> Column:
        low = F.greatest(start, begin(k))
        high = F.least(stop, end(k))
        return F.struct(
            k.alias(name),
            low.alias("at"),
            F.slice(
                "ids", (low - start + 1).cast("int"), F.greatest(F.lit(0), high - low).cast("int")
            ).alias("piece"),
        )

    numbered = offsets.filter(F.col("n_tokens") > 0).select(
        *keep, F.explode(
            F.when(first <= last, F.transform(F.sequence(first, last), piece))
        ).alias("s")
    )
    return numbered.select(*keep, "s.*").filter(F.size("piece") > 0)


def _touching(offsets: DataFrame, first: Column, last: Column, begin, end, same: tuple[str, ...]) -> DataFrame:
    """``same, ids, start, stop, touched``: the numbers of the spans that share a token with each row."""
    start, stop = F.col("start_pos"), F.col("start_pos") + F.col("n_tokens")
    numbers = F.filter(F.sequence(first, last), lambda k: (begin(k) < stop) & (end(k) > start))
    return offsets.filter((F.col("n_tokens") > 0) & (first <= last)).select(
        *same, "ids", start.alias("start"), stop.alias("stop"), numbers.alias("touched")
    )


def _whole_runs(begin, end) -> Column:
    """The spans that lie whole in a row, as one run of numbers."""
    inside = F.filter("touched", lambda k: (begin(k) >= F.col("start")) & (end(k) <= F.col("stop")))
    return F.array(F.struct(F.array_min(inside).alias("low"), F.array_max(inside).alias("high")))


def _edge_runs(begin, end) -> Column:
    """The other spans that a row touches: those that begin before it, and those that end after it."""
    before = F.array_max(F.filter("touched", lambda k: begin(k) < F.col("start")))
    after = F.array_min(F.filter("touched", lambda k: end(k) > F.col("stop")))
    return F.array(
        F.struct(F.array_min("touched").alias("low"), before.alias("high")),
        F.struct(F.when(after.isNotNull(), F.greatest(after, before + 1)).alias("low"), F.array_max("touched").alias("high")),
    )


def _reaches(runs: Column, begin, end, together: int) -> Column:
    """``group, at, piece, low, high``: a row's tokens of runs of spans, cut where a group of spans ends."""
    start, stop = F.col("start"), F.col("stop")

    def part(group: Column, run: Column) -> Column:
        low, high = F.greatest(run["low"], group * together), F.least(run["high"], (group + 1) * together - 1)
        at = F.greatest(start, begin(low))
        size = F.greatest(F.lit(0), F.least(stop, end(high)) - at).cast("int")
        return F.struct(
            group.alias("group"), at.alias("at"), F.slice("ids", (at - start + 1).cast("int"), size).alias("piece"),
            low.alias("low"), high.alias("high"),
        )

    def parts(run: Column) -> Column:
        groups = F.sequence(F.floor(run["low"] / together), F.floor(run["high"] / together))
        return F.transform(groups, lambda group: part(group, run))

    return F.flatten(F.transform(F.filter(runs, lambda run: run["low"] <= run["high"]), parts))


def _edge_pieces(rows: DataFrame, begin, end, together: int, same: tuple[str, ...]) -> DataFrame:
    """``same, __group, at, piece, low, high``: what is sent of spans that cross rows."""
    pieces = rows.select(*same, F.explode(_reaches(_edge_runs(begin, end), begin, end, together)).alias("r"))
    return pieces.select(*same, F.col("r.group").alias("__group"), "r.at", "r.piece", "r.low", "r.high")


def _shared(rows: DataFrame, begin, end, together: int, same: tuple[str, ...]) -> DataFrame:
    """``same, at, tokens, numbers``: groups of spans that cross rows, with their tokens from ``at`` on.

    What lies between two pieces belongs to spans inside a row; zeros hold its place. Pieces of
    one row may overlap.
    """
    sent = F.collect_list(F.struct("at", "piece", "low", "high"))
    groups = _edge_pieces(rows, begin, end, together, same).groupBy("__group", *same).agg(F.array_sort(sent).alias("sent"))
    ends = F.transform("sent", lambda p: p["at"] + F.size(p["piece"]))
    reached = F.concat(F.array(F.get("sent", F.lit(0))["at"]), F.slice(ends, F.lit(1), F.size("sent") - 1))

    def following(piece: Column, upto: Column) -> Column:
        gap, over = F.greatest(F.lit(0), piece["at"] - upto), F.greatest(F.lit(0), upto - piece["at"])
        rest = F.slice(piece["piece"], (over + 1).cast("int"), F.size(piece["piece"]))
        return F.concat(F.array_repeat(F.lit(0), gap.cast("int")), rest)

    return groups.select(
        *same, F.get("sent", F.lit(0))["at"].alias("at"), F.flatten(F.zip_with("sent", reached, following)).alias("tokens"),
        F.array_distinct(F.flatten(F.transform("sent", lambda p: F.sequence(p["low"], p["high"])))).alias("numbers"),
    )


def _cut_spans(groups: DataFrame, begin, end, name: str, same: tuple[str, ...]) -> DataFrame:
    """The spans that ``numbers`` names, from ``tokens`` that begin at ``at``."""
    def cut(k: Column) -> Column:
        low = F.greatest(F.lit(0), begin(k) - F.col("at"))
        size = F.greatest(F.lit(0), F.least(end(k) - F.col("at"), F.size("tokens")) - low)
        return F.struct(k.alias(name), F.slice("tokens", (low + 1).cast("int"), size.cast("int")).alias("cut"))

    spans_of = groups.select(*same, F.explode(F.transform("numbers", cut)).alias("s"))
    return spans_of.select(f"s.{name}", *same, F.col("s.cut").alias("tokens")).filter(F.size("tokens") > 0)


def token_blocks(offsets: DataFrame, block_size: int) -> DataFrame:
    """``block, tokens``: the stream cut every ``block_size`` tokens."""
    start, stop = F.col("start_pos"), F.col("start_pos") + F.col("n_tokens")
    return spans(
        offsets,
        F.floor(start / block_size),
        F.floor((stop - 1) / block_size),
        lambda k: k * block_size,
        lambda k: (k + 1) * block_size,
        "block",
    )


def shifted_windows(offsets: DataFrame, block_size: int, stride: int) -> DataFrame:
    """``start, inputs, targets`` for every ``stride``-th start with a full window."""
    start, stop = F.col("start_pos"), F.col("start_pos") + F.col("n_tokens")
    whole = spans(
        offsets,
        F.greatest(F.lit(0).cast("bigint"), F.ceil((start - block_size) / stride)),
        F.floor((stop - 1) / stride),
        lambda k: k * stride,
        lambda k: k * stride + block_size + 1,
        "w",
        together=max(1, REACH // stride),
    ).filter(F.size("tokens") == block_size + 1)
    return whole.select(
        (F.col("w") * stride).alias("start"),
        F.slice("tokens", 1, block_size).alias("inputs"),
        F.slice("tokens", 2, block_size).alias("targets"),
    )


def sampled_windows(
    offsets: DataFrame, block_size: int, samples: DataFrame, seed: int, item: str = "sample"
) -> DataFrame:
    """Windows at pseudo-random starts, drawn with replacement, one per ``samples`` row.

    A start is fixed by ``(seed, item)``. A window lies in two neighbouring blocks, and only
    rows that reach into such a block are cut up.
    """
    total = stream_length(offsets)
    draws = samples.select(
        item,
        F.floor(uniform_draw(F.lit(str(seed)), F.col(item).cast("string")) * (total - block_size))
        .cast("bigint")
        .alias("start"),
    )
    block = F.floor(F.col("start") / block_size)
    wanted = draws.select(item, "start", F.explode(F.array(block, block + 1)).alias("block"))
    # an empty last block is absent when the window ends with the one before it
    touched = offsets.join(_touched(offsets, wanted, block_size), "start_pos", "left_semi")
    found = wanted.join(token_blocks(touched, block_size), "block")
    joined = _collect_pieces(
        found.select(item, "start", F.col("block").alias("at"), F.col("tokens").alias("piece")),
        item,
        "start",
    )
    skip = (F.col("start") % block_size).cast("int")
    return joined.select(
        item,
        "start",
        F.slice("tokens", skip + 1, F.lit(block_size)).alias("inputs"),
        F.slice("tokens", skip + 2, F.lit(block_size)).alias("targets"),
    )


def _touched(offsets: DataFrame, wanted: DataFrame, block_size: int) -> DataFrame:
    """``start_pos`` of the rows with tokens in a wanted block, from lengths alone."""
    first = F.floor(F.col("start_pos") / block_size)
    last = F.floor((F.col("start_pos") + F.col("n_tokens") - 1) / block_size)
    directory = offsets.filter("n_tokens > 0").select("start_pos", F.explode(F.sequence(first, last)).alias("block"))
    return directory.join(wanted.select("block").distinct(), "block", "left_semi").select("start_pos").distinct()


def batches(
    ranked: DataFrame, rank: str, batch_size: int, *, by: tuple[str, ...] = (), drop_last: Column
) -> DataFrame:
    """Batch sizes by consecutive rank; ``drop_last`` says where a short one is dropped."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    sizes = (
        ranked.withColumn("batch_id", F.floor(F.col(rank) / batch_size).cast("bigint"))
        .groupBy(*by, "batch_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.min(rank).alias("first_rank"),
            F.max(rank).alias("last_rank"),
        )
    )
    return sizes.filter(~drop_last | (F.col("n_rows") == batch_size))


def require_batches(table: DataFrame) -> DataFrame:
    if table.isEmpty():
        raise ValueError("training split is too small for the selected batch_size")
    return table


# --- cache ------------------------------------------------------------------------


def storage_type(vocab_size: Column) -> Column:
    """Width a token id needs; Parquet packs the ids, the manifest records the width."""
    return (
        F.when(vocab_size <= UINT16_VOCAB, F.lit("uint16"))
        .when(vocab_size <= INT32_VOCAB, F.lit("int32"))
        .otherwise(F.raise_error(F.lit("vocabulary is too large for the token cache")))
    )


def content_hash(key: str = "doc_id", text: str = "text") -> Column:
    return F.md5(F.concat_ws("\x1f", F.col(key).cast("string"), F.col(text)))


def source_hash(key: str = "doc_id") -> Column:
    """Sum of the rows' content hashes, so order does not matter and a repeated row does."""
    total = F.sum(hex_to_long(content_hash(key), 15).cast("decimal(38,0)"))
    return F.pmod(total, F.lit(1 << 60).cast("decimal(38,0)")).cast("bigint")


def cache_manifest(
    docs: DataFrame, tokens: DataFrame, vocabulary: Vocabulary, key: str = "doc_id"
) -> DataFrame:
    """One row naming everything a cached token table depends on."""
    source = docs.agg(
        F.count("*").alias("source_rows"),
        F.sum(F.octet_length("text")).cast("bigint").alias("source_bytes"),
        source_hash(key).alias("source_hash"),
    )
    count = tokens.agg(F.sum("n_tokens").cast("bigint")).scalar()
    return source.select(
        F.lit(CACHE_VERSION).alias("version"),
        "source_rows",
        "source_bytes",
        "source_hash",
        F.lit(vocabulary.fingerprint).alias("vocab_sha256"),
        F.lit(vocabulary.size).cast("bigint").alias("vocab_size"),
        storage_type(F.lit(vocabulary.size)).alias("dtype"),
        count.alias("token_count"),
    )


def stale_rows(docs: DataFrame, cached: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows a cache lacks or holds with other content; ``cached`` has ``key, content``."""
    current = docs.withColumn("content", content_hash(key))
    old = cached.select(key, F.col("content").alias("old_content"))
    return (
        current.join(old, key, "left")
        .filter(F.col("old_content").isNull() | (F.col("old_content") != F.col("content")))
        .withColumn(
            "reason", F.when(F.col("old_content").isNull(), "new").otherwise("changed")
        )
        .drop("old_content")
    )


def write_token_cache(
    docs: DataFrame, vocabulary: Vocabulary, base: str, key: str = "doc_id", max_deltas: int = MAX_DELTAS
) -> tuple[DataFrame, bool]:
    """Reuse the published token table while its manifest matches, else bring it up to date.

    Returns the table (``key, content, ids, n_tokens``) and whether it was reused. A version made
    with the same vocabulary gets a delta: the rows that are new or changed, encoded, and one
    tombstone for each pair of key and content that went. So adding a row writes a row. Readers
    merge base and deltas; after ``max_deltas`` of them, and for another vocabulary, the table is
    written whole. Rows repeated in the corpus are repeated in the table.
    """
    spark = docs.sparkSession
    last = sinks.current_version(spark, base)
    wanted = _source_key(docs, vocabulary, key)
    if last is None:
        return _store_cache(_encoded(docs, vocabulary, key), wanted, base, []), False
    meta = _read_meta(spark, last["path"])
    parts = meta.pop("parts") if meta else []
    if meta == wanted:
        return read_token_cache(spark, parts, key), True
    if not meta or any(meta[c] != wanted[c] for c in ("version", "vocab_sha256", "vocab_size")):
        return _store_cache(_encoded(docs, vocabulary, key), wanted, base, []), False
    _require_story(docs)
    held = read_token_cache(spark, parts, key)
    delta = _delta(docs, held, vocabulary, key)
    if len(parts) <= max_deltas:
        return _store_cache(delta, wanted, base, parts), False
    pair = [key, "content"]
    whole = held.join(delta.filter("gone").select(*pair), pair, "left_anti").withColumn("gone", F.lit(False))
    return _store_cache(whole.unionByName(delta.filter("NOT gone")), wanted, base, []), False


def read_token_cache(spark: SparkSession, parts: list[str], key: str = "doc_id") -> DataFrame:
    """Live rows of a base folder and its deltas: those without a tombstone in a later part."""
    if len(parts) == 1:
        return spark.read.parquet(parts[0]).drop("gone")
    rows = None
    for at, path in enumerate(parts):
        part = spark.read.parquet(path).withColumn("__at", F.lit(at))
        rows = part if rows is None else rows.unionByName(part)
    ends = rows.filter("gone").select(F.col(key).alias("__key"), F.col("content").alias("__content"), F.col("__at").alias("__end"))
    ended = (F.col(key) == F.col("__key")) & (F.col("content") == F.col("__content")) & (F.col("__end") > F.col("__at"))
    return rows.filter("NOT gone").join(ends, ended, "left_anti").drop("gone", "__at")


def _delta(docs: DataFrame, held: DataFrame, vocabulary: Vocabulary, key: str) -> DataFrame:
    """Rows to add and tombstones: pairs of key and content that do not occur as often as before."""
    pair = [key, "content"]
    current = docs.filter(~is_blank(F.col("text"))).withColumn("content", content_hash(key))
    now = current.groupBy(*pair).agg(F.count("*").alias("n"))
    before = held.groupBy(*pair).agg(F.count("*").alias("m"))
    other = now.join(before, pair, "full").filter(~F.col("n").eqNullSafe(F.col("m")))
    other = materialize(other, "cache-changes")
    fresh = _encoded(docs, vocabulary, key, other.filter("n IS NOT NULL").select(*pair))
    gone = other.filter("m IS NOT NULL").select(
        *pair, F.lit(None).cast("array<int>").alias("ids"), F.lit(0).cast(fresh.schema["n_tokens"].dataType).alias("n_tokens"),
        F.lit(True).alias("gone"),
    )
    return fresh.unionByName(gone)


def _require_story(docs: DataFrame) -> None:
    if docs.filter(~is_blank(F.col("text"))).isEmpty():
        raise ValueError(EMPTY_CACHE)


def _encoded(docs: DataFrame, vocabulary: Vocabulary, key: str, only: DataFrame | None = None) -> DataFrame:
    """Encoded rows with their content; of ``only`` some pairs of key and content, if given."""
    rows = docs.select(key, content_hash(key).alias("content"), "text")
    if only is not None:
        rows = rows.join(only, [key, "content"], "left_semi")
    named = rows.select(F.struct(key, "content").alias("__row"), "text")
    return story_tokens(named, vocabulary, "__row").select(
        f"__row.{key}", "__row.content", "ids", "n_tokens", F.lit(False).alias("gone")
    )


def _source_key(docs: DataFrame, vocabulary: Vocabulary, key: str) -> dict:
    stories = docs.filter(~is_blank(F.col("text")))  # blank rows have no tokens to keep
    row = stories.agg(F.count("*").alias("rows"), source_hash(key).alias("hash")).first()
    return {
        "version": CACHE_VERSION,
        "rows": row["rows"],
        "hash": row["hash"],
        "vocab_sha256": vocabulary.fingerprint,
        "vocab_size": vocabulary.size,
    }


_META_SCHEMA = (
    "version BIGINT, rows BIGINT, hash BIGINT, vocab_sha256 STRING, vocab_size BIGINT, parts ARRAY<STRING>"
)


def _read_meta(spark: SparkSession, path: str) -> dict | None:
    rows = spark.read.schema(_META_SCHEMA).json(f"{path}-meta").limit(1).collect()
    return rows[0].asDict() if rows else None


def _store_cache(table: DataFrame, meta: dict, base: str, earlier: list[str]) -> DataFrame:
    """Publish a folder that follows ``earlier`` ones; the live table after it."""
    spark = table.sparkSession
    key = table.columns[0]

    def write(counted: DataFrame, path: str) -> None:
        counted.write.parquet(path)
        row = (*meta.values(), [*earlier, path])
        spark.createDataFrame([row], _META_SCHEMA).coalesce(1).write.json(f"{path}-meta")

    # unordered: every row has its key, and a range exchange would encode the corpus twice
    sinks.publish(table, base, F.col("n_tokens"), write, EMPTY_CACHE)
    return read_token_cache(spark, [*earlier, sinks.current_version(spark, base)["path"]], key)
