"""BPE encoding and decoding with an index of pair occurrences.

Texts are cut at white space, and each distinct piece is encoded once per worker. The words of
all new pieces of a batch are laid out in one symbol list, and every pair that has a merge is
mapped to all its positions. The active ranks are then taken in ascending order; each is applied
at all its positions at once, and the lists of the pairs beside them are updated. A pair that
appears with a lower rank than the current one is simply taken next, as a merge loop on a single
word would do.

Vocabulary files are those of the ``tokenizers`` library with NFC, white-space collapse and
lower case, a pattern split, bytes as characters, and a suffix on the last symbol of a word; the
path is a parameter. The driver reads the file (a vocabulary, of fixed size) and sends it along.

Defined results: a null text is empty and has no tokens; the strings of added tokens inside a
text are those tokens; repeated rows are encoded one by one; columns of the input that share a
name with a result column are replaced. Text and ids may be of any length. ``decode`` joins the
vocabulary strings of the ids with blanks, which is what a file without a decoder asks for; an
id that is null or not in the vocabulary is skipped.
"""

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.idtable import IdTable, ranges
from surveil.llm.words import resting, slices

CACHE_PIECES, CACHE_WORDS = 220_000, 220_000
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")
DECODED_IDS = 1 << 18   # ids decoded at a time
GROUP_BYTES = 1 << 21   # of texts whose pieces are looked up together
# Unicode white space, as the pattern of the vocabulary file understands it.
WHITE = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_ODD_SPACES = regex.compile(r"[\x1c-\x1f]")  # str.split() cuts here, the pattern does not
_PIECE = regex.compile(f"[^{WHITE}]+")

# Fixed value: the word pattern that the vocabulary file names.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# beyond Latin, Greek, Cyrillic, common punctuation and currency signs
RARE = regex.compile("[^\\x00-\\u052f\\u1e00-\\u1fff\\u2000-\\u2064\\u20a0-\\u20bf\\u2100-\\u214f]")

_models: dict[str, "PairIndexBpe"] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte value."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(moved)) for b in range(256)]


class PairIndexBpe:
    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.ids = {**model["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
        self.pieces = {i: s for s, i in self.ids.items()}
        suffix = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        self.ranks = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.by_rank = {rank: (pair, new) for pair, (rank, new) in self.ranks.items()}
        chars = byte_characters()
        self.inner = np.array([vocab.get(c, -1) for c in chars])
        self.last = np.array([vocab.get(c + suffix, -1) for c in chars])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile("\n|" + WORD_PATTERN.replace(r"\s", WHITE))
        keys = np.array([a << 20 | b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([rank for rank, _ in self.ranks.values()], np.int64)[order]
        self.words = IdTable()
        self._forget()
        self.rare_tools = None

    def words_of(self, pieces: list[str]) -> list[str]:
        """The normalised words of all pieces, with a line feed after each piece but the last."""
        joined = "\n".join(pieces)
        if joined.isascii() or not RARE.search(joined):
            # letters are lowered one by one, so a sigma does not know that it is the last
            joined = unicodedata.normalize("NFC", joined).replace("\u03a3", "\u03c3")
            return self.pattern.findall(joined.lower())
        out = []
        for piece in pieces:
            out += self._rare_words(piece) if RARE.search(piece) else self.words_of([piece])
            out.append("\n")
        return out[:-1]

    def _rare_words(self, piece: str) -> list[str]:
        """Scripts in which Unicode versions differ: letters are what the file's library takes for letters."""
        from tokenizers import Regex, normalizers, pre_tokenizers
        if self.rare_tools is None:
            self.rare_tools = (normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]),
                               pre_tokenizers.Split(Regex(WORD_PATTERN), "removed", invert=True))
        lower, split = self.rare_tools
        return [w for w, _ in split.pre_tokenize_str(lower.normalize_str(piece))]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where there is no merge."""
        keys = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each); all words are merged together through the pair index."""
        joined = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        symbols = self.inner[joined]
        symbols[ends - 1] = self.last[joined[ends - 1]]
        owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        owner, symbols = owner[symbols >= 0], symbols[symbols >= 0]
        n = len(symbols)
        inner = np.concatenate([owner[1:] == owner[:-1], [False]]) if n else np.zeros(0, bool)
        after = np.where(inner, np.arange(1, n + 1), -1)
        before = np.where(np.concatenate([[False], inner[:-1]]), np.arange(-1, n - 1), -1) if n else after
        # the index: every position of each pair that has a merge, by rank
        places = np.flatnonzero(inner)
        ranks = self.rank_of(symbols[places], symbols[places + 1])
        places, ranks = places[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        places, (active, first) = places[order], np.unique(ranks[order], return_index=True)
        index = {r: [x] for r, x in zip(active.tolist(), np.split(places, first[1:]), strict=True)} if len(active) else {}
        active = list(index)

        def note(places: np.ndarray) -> None:
            ranks = self.rank_of(symbols[places], symbols[after[places]])
            found = ranks >= 0
            for rank, place in zip(ranks[found].tolist(), places[found].tolist(), strict=True):
                if rank in index:
                    index[rank].append(place)
                else:
                    index[rank] = [place]
                    heapq.heappush(active, rank)

        while active:
            rank = heapq.heappop(active)
            (a, b), new = self.by_rank[rank]
            places = index.pop(rank)
            if isinstance(places[0], np.ndarray):
                places = np.concatenate([places[0], np.array(places[1:], np.int64)]) if len(places) > 1 else places[0]
            else:
                places = np.array(places, np.int64)
            if len(places) > 1:
                places = np.unique(places)
            places = places[(symbols[places] == a) & (after[places] >= 0)]
            places = places[symbols[after[places]] == b]
            if a == b and len(places) > 1:  # in a run of one symbol every other pair goes
                taken, last = [], -1
                for i in places.tolist():
                    if i != last:
                        taken.append(i)
                        last = int(after[i])
                places = np.array(taken, np.int64)
            if not len(places):
                continue
            gone = after[places]
            beyond = after[gone]
            symbols[places], symbols[gone] = new, -1
            after[places] = beyond
            linked = beyond >= 0
            before[beyond[linked]] = places[linked]
            ahead = before[places]
            ahead = ahead[ahead >= 0]
            touched = np.concatenate([places[linked], ahead])
            if len(touched):
                note(touched)
        left = symbols >= 0
        return symbols[left].astype(np.int32), np.bincount(owner[left], minlength=len(words))

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known yet; of each only its ids are kept."""
        words = self.words_of(pieces) if pieces else []
        if len(self.words.number) > CACHE_WORDS:
            self.words = IdTable()
        new = [w for w in set(words) if w not in self.words.number and w != "\n"]
        if new:
            self.words.add(new, *self.merge([w.encode("utf-8", "surrogatepass") for w in new]))
        if "\n" not in self.words.number:
            self.words.add(["\n"], np.zeros(0, np.int32), np.zeros(1, np.int64))     # ends a piece
        flat, starts, lengths = self.words.arrays()
        at = np.fromiter(map(self.words.number.__getitem__, words), np.int64, len(words))
        bounds = np.concatenate([[0], np.cumsum(lengths[at])])
        stops = np.concatenate([np.flatnonzero(at == self.words.number["\n"]), [len(words)]])
        self.pieces_known.add(pieces, flat[ranges(starts[at], lengths[at])], np.diff(bounds[stops], prepend=0))

    def decode(self, ids) -> str:
        return " ".join(self.pieces[i] for i in ids if i in self.pieces)

    def parts(self, text: str) -> list[str]:
        """White-space separated pieces; the strings of added tokens stand by themselves."""
        if self.special_pattern is not None and "<|" in text:
            cut = [x for x in self.special_pattern.split(text) if x]
        else:
            cut = [text]
        out = []
        for x in cut:
            out += [x] if x in self.special else _PIECE.findall(x) if _ODD_SPACES.search(x) else x.split()
        return out

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        split = [self.parts(t) if t else [] for t in texts]
        distinct = set().union(*split)
        new = [p for p in distinct if p not in self.pieces_known.number]
        if len(self.pieces_known.number) + len(new) > CACHE_PIECES:
            self._forget()
            new = [p for p in distinct if p not in self.special]
        if new:
            self._learn(new)
        flat, starts, lengths = self.pieces_known.arrays()
        sizes = np.array([len(x) for x in split], np.int64)
        at = np.fromiter((self.pieces_known.number[p] for own in split for p in own), np.int64, int(sizes.sum()))
        bounds = np.concatenate([[0], np.cumsum(lengths[at])])[np.concatenate([[0], np.cumsum(sizes)])]
        return flat[ranges(starts[at], lengths[at])], np.diff(bounds)

    def strings(self) -> np.ndarray:
        """As ``_strings`` gives them."""
        return _by_id(self.pieces)

    def rest(self) -> None:
        """Drop what was learnt: a reused worker does other work after this task, beside the model alone."""
        self.words = IdTable()
        self._forget()

    def _forget(self) -> None:
        self.pieces_known = IdTable()
        self.pieces_known.add(list(self.special), np.array(list(self.special.values()), np.int32), np.ones(len(self.special), np.int64))


def _model(text: str) -> PairIndexBpe:
    """The worker's model; kept between tasks of a reused worker."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _models:
        _models.clear()
        _models[key] = PairIndexBpe(text)
    return _models[key]


def _strings(text: str) -> np.ndarray:
    """The vocabulary's strings by id, None where there is none (the last one included); without the model's pair index."""
    spec = json.loads(text)
    return _by_id({i: s for s, i in {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}.items()})


def _by_id(pieces: dict[int, str]) -> np.ndarray:
    table = np.full(max(pieces, default=-1) + 2, None, object)
    for i, piece in pieces.items():
        table[i] = piece
    return table


def encode(docs: DataFrame, path: str, text: str = "text", digest: bool = True) -> DataFrame:
    """``docs`` without its text, plus the token ``ids`` and, with ``digest``, ``n_tokens``,
    ``ids_sha256`` and ``decoded_sha256``, which come from the ids and from decoding them, in the same
    worker: a second one for ``decode`` would stand beside it in every task. No shuffle."""
    with open(path, encoding="utf-8") as f:  # the driver's copy of a vocabulary of fixed size
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rest = [c for c in docs.columns if c not in (text, "ids", *(DIGESTS if digest else ()))]
    rows = docs.select(F.col(text).cast("string").alias(text), *[F.col(f"`{c}`") for c in rest])

    @resting
    def run(batches):
        model = _model(sent.value)
        table = model.strings() if digest else None
        for batch in batches:
            for part in slices(pc.binary_length(batch.column(0)).fill_null(0).to_pylist(), GROUP_BYTES):
                some = batch.slice(part.start, part.stop - part.start)
                flat, counts = model.encode_all(some.column(0).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat))
                own = _digests(ids, counts, table) if digest else []
                yield pa.RecordBatch.from_arrays([*some.columns[1:], ids, *own], names=[*rest, "ids", *DIGESTS[:len(own)]])
        model.rest()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    return rows.mapInArrow(run, ", ".join([*fields, "ids array<int>", *["n_tokens long", "ids_sha256 string", "decoded_sha256 string"] * digest]))


def _digests(lists: pa.ListArray, sizes: np.ndarray, table: np.ndarray) -> list[pa.Array]:
    """The columns DIGESTS of id lists; the ids are decoded in the worker that has their vocabulary."""
    written, decoded = [], []
    for part in slices(sizes.tolist(), DECODED_IDS):
        some = lists.slice(part.start, part.stop - part.start)
        written += [hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() for ids in some.to_pylist()]
        decoded += [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in _decoded(some, table)]
    return [pa.array(sizes, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())]


def _decoded(lists: pa.ListArray, table: np.ndarray) -> list[str | None]:
    """The vocabulary strings of id lists, joined with blanks; null for a null list."""
    flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    strings = table[np.where((flat >= 0) & (flat < len(table) - 1), flat, -1)]
    at, own = 0, []
    for size, there in zip([x or 0 for x in lists.value_lengths().to_pylist()], lists.is_valid().to_pylist(), strict=True):
        own.append(" ".join([x for x in strings[at:at + size].tolist() if x is not None]) if there else None)
        at += size
    return own


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` plus the decoded text of an id list (null for a null list)."""
    with open(path, encoding="utf-8") as f:
        sent = rows.sparkSession.sparkContext.broadcast(f.read())
    rest = [c for c in rows.columns if c != text]
    shaped = rows.select(*[F.col(f"`{c}`") for c in rest])

    @resting
    def run(batches):
        table = _strings(sent.value)
        for batch in batches:
            lists = batch.column(rest.index(ids))
            sizes = [x or 0 for x in lists.value_lengths().to_pylist()]
            for part in slices(sizes, DECODED_IDS):
                some = lists.slice(part.start, part.stop - part.start)
                own = _decoded(some, table)
                yield pa.RecordBatch.from_arrays([*[c.slice(part.start, len(own)) for c in batch.columns], pa.array(own, pa.string())], names=[*rest, text])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in shaped.schema.fields]
    return shaped.mapInArrow(run, ", ".join([*fields, f"`{text}` string"]))


def digests(rows: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """``rows`` with ``n_tokens`` and both digests, from the ids and from decoding them."""
    written = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    found = {"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(written, 256), "decoded_sha256": F.sha2("decoded", 256)}
    kept = [c for c in rows.columns if c not in found and (keep_ids or c != "ids")]
    return decode(rows, path).select(*[F.col(f"`{c}`") for c in kept], *[v.alias(c) for c, v in found.items()])


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(encode(docs, vocabulary_path(), digest=False), vocabulary_path())
