"""Token ids in Parquet files that can be read selectively.

A data set of token ids is a folder of Parquet files with a row per document, in ascending
order of ``doc_id`` over all files. ``tokens`` is a list column with dictionary encoding
(the vocabulary fits one dictionary page); the integer columns around it are delta encoded
and kept apart, so that sizes and places can be read without touching a token. Row groups
and pages are small, and Parquet's page indexes let a filter on ``doc_id`` skip pages.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.tables import read_table, slices, tidy, worker_cache
from presswork.storage import new_folder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
# Texts handed over at once hold this many characters, or one text.
BATCH_CHARS = 1_000_000
# Pieces of text a worker remembers the ids of, in each of two generations.
CACHE_PIECES = 300_000
# Slots, of a byte each, for pieces that a worker has seen once.
SEEN_SLOTS = 1 << 23
# Characters of new pieces that go through the tokenizer as one string.
JOINED_CHARS = 50_000
# The same for plain pieces, which are no longer than ``PLAIN_CHARS``; short strings are faster.
JOINED_PIECES = 200
PLAIN_CHARS = 200
# Characters, in a pattern's brackets, that a byte-level pattern divides by kind alone: no
# apostrophe, which makes contractions, and beyond ASCII only letters of Latin alphabets.
PLAIN = "!-&(-~À-ÖØ-öø-ſ"
# Tokens that can stand in pieces of these, characters begun or ended by a neighbour included,
# and those that lie within one kind. White space other than a leading space stands alone.
PLAIN_BYTES = (
    rb"[\x80-\xbf]?(?:[!-&(-~]|[\t\n](?![\t\n])| (?![\t\n ])|[\xc3-\xc5][\x80-\xbf])*[\xc3-\xc5]?"
)
UNDIVIDED_BYTES = rb"\s| ?(?:[A-Za-z\x80-\xff]+|[0-9]+|[!-/:-@[-`{-~]+)"
ROW_GROUP_BYTES = 32 << 20
PAGE_ROWS = 1000

FILE_SCHEMA = (
    "doc_id long, part int, start_in_part long, n_tokens long, tokens array<int>"
)
_WRITE = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#tokens.list.element": "true",
}


def _alphabet() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for."""
    from tokenizers import pre_tokenizers

    letters = sorted(pre_tokenizers.ByteLevel.alphabet())
    own = {ord(letter) for letter in letters if ord(letter) < 256}
    others = (byte for byte in range(256) if byte not in own)
    return {letter: ord(letter) if ord(letter) < 256 else next(others) for letter in letters}


class _Encoder:
    """Little-endian ids of a text, as bytes.

    A byte-level tokenizer without a normaliser never joins what stands before a space
    with the space, if a character other than white space follows. Texts are cut there,
    pieces that are not known go through the tokenizer, and the ids of a text are those of
    its pieces, one after the other. The new pieces of some texts are joined, each once, so they
    never cost more than the texts; where the ids of each begin follows from the bytes that ids
    stand for. A piece is remembered when it is seen again, so the many that stand
    once take no room, and the older generation goes when the newer one is full.
    Pieces of ``PLAIN`` characters go through the same model without the tokenizer's pattern,
    if no token reaches over a place where the pattern would have divided them.
    Any other tokenizer gets the texts as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self._tokenizer.to_str())
        before = spec.get("pre_tokenizer") or {}
        added = {token["id"]: token["content"] for token in spec.get("added_tokens") or []}
        self._cut = self._plain = None
        if (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and not any(" " in content for content in added.values())
        ):
            self._cut = re.compile(r" (?=\S)").split
            self._odd = re.compile(r" (?!\S)").search
            self._prepare_plain(spec["model"], added)
        vocabulary = self._tokenizer.get_vocab()
        self._bytes = np.zeros(max(vocabulary.values(), default=0) + 1, "i8")
        for token, number in vocabulary.items():  # a character of a token is a byte
            self._bytes[number] = len(added[number].encode() if number in added else token)
        self._memory = worker_cache(f"pieces of {path}")
        if not self._memory:
            self._memory |= {"new": {}, "old": {}, "seen": np.zeros(SEEN_SLOTS, "u1"), "marked": 0}

    def _prepare_plain(self, model: dict, added: dict[int, str]) -> None:
        """Sets ``_plain``, the test of a piece, where the model needs no pattern for it."""
        from tokenizers import Tokenizer, pre_tokenizers

        byte_of = _alphabet()
        if (
            model.get("type") != "BPE"
            or any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "unk_token"))
            or any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
            or not byte_of.keys() <= model["vocab"].keys()
        ):
            return
        can_stand = re.compile(PLAIN_BYTES).fullmatch
        undivided = re.compile(UNDIVIDED_BYTES).fullmatch
        leads = np.zeros(max(model["vocab"].values()) + 1, "?")
        for token, number in model["vocab"].items():
            # Tokens with other characters than the alphabet's come from no text.
            raw = bytes([byte_of.get(letter, 0) for letter in token])
            if not undivided(raw) and can_stand(raw):
                return
            leads[number] = raw[:1] == b" "
        # An added token is found by the full tokenizer only.
        firsts = {content[:1] for content in added.values()}
        usual = "".join({c for c in map(chr, range(384)) if re.match(f"[{PLAIN}]", c)} - firsts)
        word = f"[{re.escape(usual)}]+"
        self._plain = re.compile(rf"{word}(?:[\t\n]{word})*[\t\n]?").fullmatch
        self._doubt = re.compile(rf"[^{re.escape(usual)} \t\n]").search
        self._bare = Tokenizer(self._tokenizer.model)
        self._bare.pre_tokenizer = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=False
        )
        self._leads = leads

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _pieces(self, text: str) -> list[str]:
        # Where every space has something behind it, cutting at each is the same and faster.
        return self._cut(text) if self._odd(text) else text.split(" ")

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        sizes = np.fromiter(map(len, pieces), "i8", len(pieces)) + 1
        group = np.cumsum(sizes) // JOINED_CHARS
        borders = np.searchsorted(group, np.arange(group[-1] + 2 if len(group) else 1)).tolist()
        groups = [(a, b) for a, b in zip(borders, borders[1:], strict=False) if a < b]
        # Each piece has its space in front again.
        texts = [" " + " ".join(pieces[a:b]) for a, b in groups]
        out: list[bytes] = []
        for (a, b), text, ids in zip(groups, texts, self._ids(texts), strict=True):
            wide = sizes[a:b]
            if not text.isascii():
                wide = np.array([len(piece.encode()) + 1 for piece in pieces[a:b]])
            reached = np.concatenate([[0], np.cumsum(self._bytes[ids])])
            wanted = np.concatenate([[0], np.cumsum(wide)])
            cuts = np.searchsorted(reached, wanted)
            if cuts[-1] != len(ids) or (reached[cuts] != wanted).any():
                out += [x.tobytes() for x in self._ids([" " + piece for piece in pieces[a:b]])]
                continue
            raw, at = ids.tobytes(), (4 * cuts).tolist()
            out += [raw[i:j] for i, j in zip(at, at[1:], strict=False)]
        return out

    def _plain_of(self, pieces: set[str]) -> list[str]:
        if self._plain is None or not pieces:
            return []
        # Where none is in doubt, one look at all of them is enough.
        text = " ".join(pieces)
        if (
            not self._doubt(text)
            and not any(run in text for run in ("\n\n", "\n\t", "\t\n", "\t\t"))
            and text.count(" ") == len(pieces) - 1
            and max(map(len, pieces)) <= PLAIN_CHARS
        ):
            return list(pieces)
        return [p for p in pieces if len(p) <= PLAIN_CHARS and self._plain(p)]

    def _encode_plain(self, pieces: list[str]) -> list[bytes]:
        if not pieces:
            return []
        starts = range(0, len(pieces), JOINED_PIECES)
        texts = [" " + " ".join(pieces[a : a + JOINED_PIECES]) for a in starts]
        found = self._bare.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array([number for x in found for number in x.ids], "<u4")
        # Spaces stand before pieces only, and a token has one at its begin only.
        raw, at = ids.tobytes(), (4 * np.flatnonzero(self._leads[ids])).tolist()
        return [raw[i:j] for i, j in zip(at, [*at[1:], len(raw)], strict=True)]

    def _remember(self, pieces: list[str], coded: list[bytes]) -> None:
        memory = self._memory
        slots = np.fromiter(map(hash, pieces), "i8", len(pieces)) & (SEEN_SLOTS - 1)
        again = memory["seen"][slots]
        if memory["marked"] > SEEN_SLOTS // 4:
            memory["seen"][:] = 0
            memory["marked"] = 0
        memory["seen"][slots] = 1
        memory["marked"] += len(pieces)
        for i in np.flatnonzero(again).tolist():
            memory["new"][pieces[i]] = coded[i]
        if len(memory["new"]) > CACHE_PIECES:
            memory["old"], memory["new"] = memory["new"], {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self._cut is None:
            return [ids.tobytes() for ids in self._ids(texts)]
        new, old = self._memory["new"], self._memory["old"]
        # Of a text's pieces only the unknown ones are kept: the others' room is used again by
        # the next text, while it is still in the processor's cache.
        heads, coded, gaps, rest = [], [], [], set()
        for text in texts:
            pieces = self._pieces(text)
            # The first piece has no space before it; the others are known without theirs.
            heads.append(pieces.pop(0))
            found = list(map(new.get, pieces))
            places = [i for i, ids in enumerate(found) if ids is None]
            missing = [pieces[i] for i in places]
            coded.append(found)
            gaps.append((places, missing))
            rest.update(missing)
        ids_of = {piece: old[piece] for piece in rest if piece in old}
        new |= ids_of
        rest.difference_update(ids_of)
        plain = self._plain_of(rest)
        rest.difference_update(plain)
        unknown = plain + list(rest)
        found = self._encode_plain(plain) + self._encode_pieces(unknown[len(plain) :])
        ids_of.update(zip(unknown, found, strict=True))
        self._remember(unknown, found)
        for ids, (places, missing) in zip(coded, gaps, strict=True):
            for i, piece in zip(places, missing, strict=True):
                ids[i] = ids_of[piece]
        return [
            head.tobytes() + b"".join(ids)
            for head, ids in zip(self._ids(heads), coded, strict=True)
        ]


def _encoder(path: str) -> _Encoder:
    """The worker's encoder for the file as it is now: reading it takes as long as encoding a
    megabyte."""
    state = os.stat(path)
    made = worker_cache(f"encoder of {path}")
    key = (state.st_mtime_ns, state.st_size)
    if made.get("key") != key:
        worker_cache(f"pieces of {path}").clear()
        made |= {"encoder": _Encoder(path), "key": key}
    return made["encoder"]


def _chunks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = _encoder(path), 0
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        for batch in (part for whole in batches for part in slices(whole)):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in _chunks(texts, BATCH_CHARS):
                coded = [x + end for x in encoder(texts[a:b])]
                sizes = np.array([len(x) // 4 for x in coded], "i8")
                ends = np.cumsum(sizes)
                values = np.frombuffer(b"".join(coded), "<u4").astype("i4")
                tokens = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array(np.full(b - a, part, "i4")),
                        pa.array(start + ends - sizes),
                        pa.array(sizes),
                        tokens,
                    ],
                    ["doc_id", "part", "start_in_part", "n_tokens", "tokens"],
                )
                start += int(ends[-1])

    return tidy(run)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """The ids of every whole ``text`` of ``docs``, each followed by ``end_id``, into
    ``folder``. ``tokenizer``: the path of a tokenizers file, the same on all machines.

    Texts are dealt out by ranges of ``doc_id`` and encoded where they arrive, so each file
    is a range of documents. A null text is an empty one: its only id is ``end_id``. Rows
    with equal ``doc_id`` lie side by side, ordered by text; a null ``doc_id`` comes first.
    Special tokens' strings in a text are treated as the tokenizer's file says. Other
    columns are left out. An empty table gives a folder without rows.
    """
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    coded = ordered.mapInArrow(_encode(tokenizer, end_id), FILE_SCHEMA)
    coded.write.options(**_WRITE).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The files as they are. Columns and filters reach the scan: pick the columns needed,
    filter by ``doc_id`` to read some documents only."""
    return spark.read.schema(FILE_SCHEMA).parquet(folder)


def part_offsets(files: DataFrame) -> DataFrame:
    """``part, part_start``: the ids in all parts before. A row for each part, that is
    for each writing task; read from the metadata columns alone."""
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("part_start"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column("tokens")
        values = np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False), "<u4")
        raw, at = memoryview(values).cast("B"), tokens.offsets.to_pylist()
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(sums, pa.int64())],
            ["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"],
        )


def token_digests(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    schema = "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long"
    sums = files.select("doc_id", "part", "start_in_part", "n_tokens", "tokens").mapInArrow(
        _digest, schema
    )
    placed = sums.join(part_offsets(files), "part")
    start = F.col("part_start") + F.col("start_in_part")
    return placed.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return token_digests(read_tokens(spark, folder))
