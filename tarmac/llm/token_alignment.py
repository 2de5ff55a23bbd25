"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and how often.

Every text is encoded by a byte-level vocabulary (A, after a space) and by a piece
vocabulary (B, which adds that space itself). Where tokens of both end at one byte, the text
is cut into groups; the last A token and the last B token of a group are linked. How often
an id pair is linked is counted over all documents, and every document gets back the counts
of its own links.

**Encoding.** Both vocabularies can be cut before a single space that follows another
character: no rule of A's splitting pattern and no piece of B reaches over it. So texts are
encoded by their atoms, stretches between such cuts; an atom's tokens, groups and links are
kept in the worker, up to a fixed number of atoms.

**Counting** by external spills:

1. A task gathers the links of consecutive documents, up to ``RUN_LINKS``, sorts them side
   by side, B first, and cuts them by a radix of the B id. Each part is one row: a run of
   pairs, totals and documents, differences in transposed bytes under zstd. The runs are
   written to the checkpoint folder, so a lost executor costs its own tasks only.
2. The pairs and totals of a part's runs, not their documents, are merged by a heap,
   ``FAN_IN`` runs at a time in as many rounds as that takes. So a frequent pair is one
   entry a run, whatever number of documents hold it. As B comes first, the pairs of a B id
   end together, and with them its highest count is known.
3. The counts return to the runs of their part, ``FAN_IN`` of them a group, and each run adds
   up what its documents get. The sums of a run meet its documents.

A text that is null, empty or does not come back from both vocabularies byte by byte has no
tokens. Strings of special tokens are plain text. Texts are taken whole, however long. Rows
are separate documents whether their ids or texts repeat; an empty table gives an empty
one; only ``doc_id`` and ``text`` are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.packed import squeeze, stretch
from tarmac.llm.texts import Words, distinct, flat, slices, small_batches, word_hashes
from tarmac.session import ensure_checkpoint_dir

#: Links and documents of a run, at most (but for its last document).
RUN_LINKS, RUN_DOCUMENTS = 1_000_000, 50_000
#: Runs that are merged at once.
FAN_IN = 64
#: Parts by the B id.
RADIX_BITS = 6
#: Atoms that a worker keeps.
CACHE_ATOMS = 800_000

_SPACE = 0x20
# A cut needs a character after the space that is no white space. Characters of these lead
# bytes may be, so there is none before them.
_MAY_FOLLOW = np.ones(256, bool)
_MAY_FOLLOW[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = False
#: Atoms that are encoded as one text.
_JOINED = 200
_BLOCK = "\u2581"


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte, by its public rule:
    printable ones as they are, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Atoms:
    """Tokens, groups and links of atoms under both vocabularies."""

    def __init__(self, byte_vocabulary: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_vocabulary)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        special = {t["content"] for t in json.loads(self.a.to_str())["added_tokens"]}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            if token not in special:
                assert all(c in letters for c in token)
                self.a_size[i] = len(token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        ids = range(self.b.get_piece_size())
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLOCK, " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in ids)
        ]
        self.b_size = np.array([len(p) for p in self.b_bytes])
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.counts = np.zeros((0, 3), np.int64)  # A tokens, B tokens, groups
        self.fits = np.zeros(0, bool)
        self.first_link = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.uint64)
        self.told: list[bytes] = []

    def _encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
        """Ids under both, and whether B's bytes are the text's, of texts that begin with
        a space."""
        a = [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        piece = self.b_bytes.__getitem__
        fits = [b"".join(map(piece, ids)) == t.encode() for ids, t in zip(b, texts)]
        return a, [np.array(ids, np.int64) for ids in b], fits

    def learn(self, keys: np.ndarray, atoms: list[str]) -> None:
        """Keep what the atoms, whose hashes are ``keys``, give."""
        # A text of several atoms: none ends in a space, and each begins with one space alone.
        plain = [t[1:2].strip() != "" and t[-1] != " " and _BLOCK not in t for t in atoms]
        order = [k for k, p in enumerate(plain) if p] + [k for k, p in enumerate(plain) if not p]
        n_plain = sum(plain)
        rows = [order[k : min(k + _JOINED, n_plain)] for k in range(0, n_plain, _JOINED)]
        rows += [[k] for k in order[n_plain:]]
        a, b, fits = self._encode(["".join(atoms[k] for k in row) for row in rows])
        again = [r for r, (row, fit) in enumerate(zip(rows, fits)) if not fit and len(row) > 1]
        if again:  # find the atoms that do not fit
            own = [[k] for r in again for k in rows[r]]
            more = self._encode([atoms[row[0]] for row in own])
            for kept, new in zip((a, b, fits, rows), (*more, own)):
                for r in reversed(again):
                    del kept[r]
                kept += new
        bad = [row[0] for row, fit in zip(rows, fits) if not fit]
        good = [r for r, fit in enumerate(fits) if fit]
        order = [k for r in good for k in rows[r]]
        none = np.zeros(0, np.int64)
        a_ids = np.concatenate([none, *(a[r] for r in good)])
        b_ids = np.concatenate([none, *(b[r] for r in good)])
        a_end, b_end = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        atom_end = np.cumsum([len(atoms[k].encode()) for k in order], dtype=np.int64)
        group_end = np.intersect1d(a_end, b_end)
        a_last, b_last = np.searchsorted(a_end, group_end), np.searchsorted(b_end, group_end)
        links = (b_ids[b_last].astype(np.uint64) << np.uint64(32)) | a_ids[a_last].astype(np.uint64)
        till = [np.searchsorted(e, atom_end, side="right") for e in (a_end, b_end, group_end)]
        told = self._told(a_ids, b_ids, a_last, b_last)
        told = [
            ";".join([*told[low:high], ""]).encode()
            for low, high in zip([0, *till[2][:-1].tolist()], till[2].tolist())
        ]
        size = len(self.told)
        new = np.zeros((len(atoms), 3), np.int64)
        new[: len(order)] = np.stack([np.diff(t, prepend=0) for t in till], axis=1)
        self.counts = np.concatenate([self.counts, new])
        self.fits = np.concatenate([self.fits, np.ones(len(order), bool), np.zeros(len(bad), bool)])
        first = np.concatenate([np.cumsum(new[:, 2]) - new[:, 2]]) + len(self.links)
        self.first_link = np.concatenate([self.first_link, first])
        self.links = np.concatenate([self.links, links])
        self.told += told + [b""] * len(bad)
        own_keys = keys[np.array(order + bad, np.int64)]
        by_key = np.argsort(own_keys)
        at = np.searchsorted(self.keys, own_keys[by_key])
        self.keys = np.insert(self.keys, at, own_keys[by_key])
        self.place = np.insert(self.place, at, size + by_key)

    @staticmethod
    def _told(a_ids, b_ids, a_last, b_last) -> list[str]:
        """Each group as ``a1,a2|b1``."""
        a, b = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        out, i, j = [], 0, 0
        for k, m in zip((a_last + 1).tolist(), (b_last + 1).tolist()):
            out.append(
                f"{a[i] if k == i + 1 else ','.join(a[i:k])}|{b[j] if m == j + 1 else ','.join(b[j:m])}"
            )
            i, j = k, m
        return out

    def of(self, words: Words) -> np.ndarray:
        """For each atom where it is kept."""
        hashes, first_seen, which = distinct(word_hashes(words))
        if len(self.keys) > CACHE_ATOMS:
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        inside = at < len(self.keys)
        known = np.zeros(len(hashes), bool)
        known[inside] = self.keys[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            self.learn(hashes[new], [words.bytes_of(k).decode() for k in first_seen[new]])
        return self.place[np.searchsorted(self.keys, hashes)][which]


@lru_cache(maxsize=1)
def _atoms(byte_vocabulary: str, piece_model: str) -> Atoms:
    """One table per worker process, kept from task to task."""
    return Atoms(byte_vocabulary, piece_model)


def split_atoms(texts: pa.Array) -> Words:
    """Atoms of the texts, each with a space put before it."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    spaced = pc.binary_join_element_wise(
        pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())
    )
    data, begins = flat(spaced)
    cut = data == _SPACE
    follows = np.append(data, np.uint8(_SPACE))[1:]
    cut[1:] &= ~(data[:-1] == _SPACE)
    cut &= _MAY_FOLLOW[follows]
    cut[begins[:-1]] = True
    start = np.flatnonzero(cut)
    end = np.append(start, len(data))[1:]
    return Words(data, begins, start, end, np.searchsorted(start, begins))


def _ascending(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=values.dtype.type(0)))


def _ascended(packed: bytes) -> np.ndarray:
    return np.cumsum(stretch(packed), dtype=np.uint64)


def radix(pairs: np.ndarray) -> np.ndarray:
    """The part that each pair belongs to, by its B id."""
    spread = (pairs >> np.uint64(32)) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)
    return spread >> np.uint64(32 - RADIX_BITS)


def sorted_run(pairs: np.ndarray, docs: np.ndarray) -> Iterator[dict]:
    """The links (pair, document) as one run for each part that occurs."""
    part = radix(pairs)
    order = np.lexsort((docs, pairs, part))
    pairs, docs, part = pairs[order], docs[order].astype(np.uint32), part[order]
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (pairs[1:] != pairs[:-1]) | (docs[1:] != docs[:-1])
    entry = np.flatnonzero(fresh)
    times = np.diff(entry, append=len(pairs)).astype(np.uint32)
    pairs, docs, part = pairs[entry], docs[entry], part[entry]
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=1 << RADIX_BITS))
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = pairs[low:high]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        yield {
            "part": int(part[low]),
            "pairs": _ascending(own[first]),
            "totals": squeeze(np.add.reduceat(times[low:high].astype(np.uint64), first)),
            "holders": squeeze(np.diff(first, append=len(own)).astype(np.uint32)),
            "docs": squeeze(docs[low:high]),
            "times": squeeze(times[low:high]),
        }


_RUN = pa.schema(
    [
        ("run", pa.int64()), ("part", pa.int32()), ("index", pa.int32()), ("doc_id", pa.int64()),
        ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("totals", pa.binary()),
        ("holders", pa.binary()), ("docs", pa.binary()), ("times", pa.binary()),
    ]
)
_RUN_DDL = (
    "run bigint, part int, index int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
    "groups_sha256 string, pairs binary, totals binary, holders binary, docs binary, times binary"
)
_PARTS = ("part", "pairs", "totals", "holders", "docs", "times")


def _aligned(words: Words, atoms: Atoms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each atom is kept, counts per text, and which texts have tokens."""
    place = atoms.of(words)
    first = words.first[:-1]
    counts = np.add.reduceat(atoms.counts[place], first, axis=0)
    fine = np.logical_and.reduceat(atoms.fits[place], first) & (np.diff(words.begins) > 1)
    counts[~fine] = 0
    return place, counts, fine


def _told_of(words: Words, place: np.ndarray, atoms: Atoms, fine: np.ndarray) -> Iterator[bytes]:
    told, at = atoms.told.__getitem__, place.tolist()
    for low, high, fit in zip(words.first[:-1].tolist(), words.first[1:].tolist(), fine.tolist()):
        yield b"".join(map(told, at[low:high]))[:-1] if fit else b""


def _runs(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """Rows of documents (``part`` is null) and of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        atoms = _atoms(byte_vocabulary, piece_model)
        name = TaskContext.get().partitionId() << 32
        links: list[np.ndarray] = []
        of_doc: list[np.ndarray] = []
        held = n_docs = 0

        def close() -> pa.RecordBatch:
            rows = list(sorted_run(np.concatenate(links), np.concatenate(of_doc)))
            columns = {c: [r[c] for r in rows] for c in _PARTS} | {"run": [name] * len(rows)}
            return _batch(columns, len(rows))

        for batch in slices(batches, "text"):
            words = split_atoms(batch.column("text"))
            place, counts, fine = _aligned(words, atoms)
            sha = [
                hashlib.sha256(t).hexdigest() if t else ""
                for t in _told_of(words, place, atoms, fine)
            ]
            n = batch.num_rows
            yield _batch(
                {
                    "run": [name] * n,
                    "index": np.arange(n_docs, n_docs + n),
                    "doc_id": batch.column("doc_id"),
                    "n_a": counts[:, 0],
                    "n_b": counts[:, 1],
                    "n_groups": counts[:, 2],
                    "groups_sha256": sha,
                },
                n,
            )
            used = np.repeat(fine, np.diff(words.first))
            size = atoms.counts[place, 2] * used
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            links.append(atoms.links[np.repeat(atoms.first_link[place], size) + step])
            of_doc.append(np.repeat(words.text_of() + n_docs, size))
            held += len(links[-1])
            n_docs += n
            if held >= RUN_LINKS or n_docs >= RUN_DOCUMENTS:
                if held:
                    yield close()
                links, of_doc, held, n_docs, name = [], [], 0, 0, name + 1
        if held:
            yield close()

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, _RUN_DDL)


def _batch(columns: dict, n: int) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _RUN
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_RUN)


def heap_merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and totals of ascending runs as one run."""
    if len(runs) == 1:
        return runs[0]
    pairs: list[int] = []
    totals: list[int] = []
    last = -1
    for pair, n in heapq.merge(*(zip(p.tolist(), t.tolist()) for p, t in runs)):
        if pair == last:
            totals[-1] += n
        else:
            pairs.append(pair)
            totals.append(n)
            last = pair
    return np.array(pairs, np.uint64), np.array(totals, np.uint64)


def highest(pairs: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Whether the count of each pair is the highest of its B id; pairs ascend."""
    side = pairs >> np.uint64(32)
    first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    most = np.maximum.reduceat(totals, first)
    return totals == np.repeat(most, np.diff(first, append=len(pairs)))


def _merged(table: pa.Table) -> pa.Table:
    pairs, totals = heap_merge(
        [
            (_ascended(p), stretch(t))
            for p, t in zip(table["pairs"].to_pylist(), table["totals"].to_pylist())
        ]
    )
    return pa.table(
        {
            "part": pa.array([table["part"][0].as_py()], pa.int32()),
            "run": pa.array([table["run"][0].as_py()], pa.int64()),
            "pairs": pa.array([_ascending(pairs)], pa.binary()),
            "totals": pa.array([squeeze(totals)], pa.binary()),
        }
    )


def _groups_of(run: str, n: int) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(max(1, n))).cast("int").alias("pack")


def _part_counts(runs: DataFrame, n_runs: int) -> DataFrame:
    """(part, pairs, totals): one row a part, over all its runs."""
    rows, n = runs.select("part", "run", "pairs", "totals"), n_runs
    while True:
        n = math.ceil(n / FAN_IN)
        packed = rows.withColumn("pack", _groups_of("run", n))
        rows = packed.groupBy("part", "pack").applyInArrow(
            _merged, "part int, run bigint, pairs binary, totals binary"
        )
        if n <= 1:
            return rows.select("part", "pairs", "totals").checkpoint()
        rows = rows.checkpoint()


def _contributions(left: pa.Table, right: pa.Table) -> pa.Table:
    """For each run of ``left`` what its documents get from the counts in ``right``."""
    out: dict[str, list] = {"run": [], "docs": [], "best": [], "sums": []}
    if right.num_rows and left.num_rows:
        pairs = _ascended(right["pairs"][0].as_py())
        totals = stretch(right["totals"][0].as_py())
        best = highest(pairs, totals)
        columns = (left[c].to_pylist() for c in ("run", "pairs", "holders", "docs", "times"))
        for name, own, holders, docs, times in zip(*columns):
            at = np.repeat(np.searchsorted(pairs, _ascended(own)), stretch(holders).astype(np.int64))
            docs, times = stretch(docs), stretch(times).astype(np.uint64)
            order = np.argsort(docs, kind="stable")
            docs, at, times = docs[order], at[order], times[order]
            first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
            out["run"].append(name)
            out["docs"].append(_ascending(docs[first]))
            out["best"].append(squeeze(np.add.reduceat(times * best[at], first)))
            out["sums"].append(squeeze(np.add.reduceat(times * totals[at], first)))
    types = {"run": pa.int64(), "docs": pa.binary(), "best": pa.binary(), "sums": pa.binary()}
    return pa.table({c: pa.array(v, types[c]) for c, v in out.items()})


def _with_sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a run and the sums of all its parts."""
    index = left["index"].to_numpy()
    best, sums = (np.zeros(int(index.max(initial=-1)) + 1, np.uint64) for _ in range(2))
    for docs, b, s in zip(*(right[c].to_pylist() for c in ("docs", "best", "sums"))):
        docs = _ascended(docs).astype(np.int64)
        best[docs] += stretch(b)
        sums[docs] += stretch(s)
    kept = left.select(["doc_id", "n_a", "n_b", "n_groups"])
    for name, values in (
        ("n_links", left["n_groups"]),
        ("n_best", pa.array(best[index].astype(np.int64))),
        ("count_sum", pa.array(sums[index].astype(np.int64))),
        ("groups_sha256", left["groups_sha256"]),
    ):
        kept = kept.append_column(name, values)
    return kept


def _counted(docs: DataFrame, byte_vocabulary: str, piece_model: str):
    ensure_checkpoint_dir(docs.sparkSession)
    rows = _runs(docs, byte_vocabulary, piece_model).checkpoint()
    runs = rows.filter("part IS NOT NULL").drop("index", "doc_id", "n_a", "n_b", "n_groups")
    n_runs = runs.select("run").distinct().count()
    return rows, runs, n_runs, _part_counts(runs, n_runs)


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row:
    numbers of tokens, groups and links, links whose count is the highest of their B id, and
    the sum of the links' counts."""
    rows, runs, n_runs, counts = _counted(docs, byte_vocabulary, piece_model)
    packs = max(1, math.ceil(n_runs / FAN_IN))
    each = counts.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    gains = (
        runs.withColumn("pack", _groups_of("run", packs))
        .groupBy("part", "pack")
        .cogroup(each.groupBy("part", "pack"))
        .applyInArrow(_contributions, "run bigint, docs binary, best binary, sums binary")
    )
    of_docs = rows.filter("part IS NULL").select(
        "run", "index", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"
    )
    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
        "count_sum bigint, groups_sha256 string"
    )
    return of_docs.groupBy("run").cogroup(gains.groupBy("run")).applyInArrow(_with_sums, schema)


def pair_counts(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """(a, b, n, best): how often the ids are linked over all documents, and whether no
    other A id is linked with b more often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, t in zip(*(batch.column(c).to_pylist() for c in ("pairs", "totals"))):
                pairs, totals = _ascended(p), stretch(t)
                yield pa.RecordBatch.from_pydict(
                    {
                        "a": (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64),
                        "b": (pairs >> np.uint64(32)).astype(np.int64),
                        "n": totals.astype(np.int64),
                        "best": highest(pairs, totals),
                    }
                )

    counts = _counted(docs, byte_vocabulary, piece_model)[-1]
    return counts.mapInArrow(run, "a bigint, b bigint, n bigint, best boolean")


def groups(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """doc_id and the groups of every row as ``a1,a2|b1;a3|b2,b3``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        atoms = _atoms(byte_vocabulary, piece_model)
        for batch in slices(batches, "text"):
            words = split_atoms(batch.column("text"))
            place, _, fine = _aligned(words, atoms)
            told = [t.decode() for t in _told_of(words, place, atoms, fine)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(told, pa.string())], ["doc_id", "groups"]
            )

    rows = small_batches(docs).select("doc_id", "text")
    return rows.mapInArrow(run, "doc_id bigint, groups string")
