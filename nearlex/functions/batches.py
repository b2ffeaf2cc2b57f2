"""Array work on Arrow batches: counting and character n-grams by distinct word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words that are cut at a time.
CUT_WORDS = 20_000


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


def coded(lists: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of all elements, what the codes stand for, and the sizes of the lists; a null element is coded as a null."""
    flat = pc.list_flatten(lists)
    if not pa.types.is_dictionary(flat.type):
        flat = flat.dictionary_encode()
    codes, meant = flat.indices, flat.dictionary
    if codes.null_count:
        codes, meant = pc.fill_null(codes, len(meant)), pa.concat_arrays([meant, pa.nulls(1, meant.type)])
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return codes.to_numpy(zero_copy_only=False).astype(np.int64), meant, sizes


def listed(codes: np.ndarray, meant: pa.Array, sizes: np.ndarray, like: pa.Array) -> pa.Array:
    """Lists of coded elements, null where ``like`` is; they are spelled out where they leave the worker."""
    values = pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), meant)
    return pa.ListArray.from_arrays(_offsets(sizes), values, mask=like.is_null() if like.null_count else None)


def count_batch(tokens: pa.Array) -> pa.Array:
    """Terms of each list with their counts, sorted by term."""
    codes, meant, sizes = coded(tokens)
    order = np.asarray(pc.sort_indices(meant))
    # Equal terms have one rank, though they may have several codes.
    spelled = meant.take(pa.array(order))
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = ~np.asarray(pc.fill_null(pc.equal(spelled[1:], spelled[:-1]), False))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    first, width = np.flatnonzero(new), max(len(order), 1)
    key, n = np.unique(np.repeat(np.arange(len(sizes)), sizes) * width + rank[codes], return_counts=True)
    terms = spelled.take(pa.array(first[key % width]))
    pairs = pa.StructArray.from_arrays([terms, pa.array(n, pa.int64())], names=["term", "tf"])
    return pa.ListArray.from_arrays(_offsets(np.bincount(key // width, minlength=len(tokens))), pairs)


def bag_batch(tokens: pa.Array) -> pa.Array:
    """The size of each list, null for a null one, beside its ``count_batch``."""
    return pa.StructArray.from_arrays([pc.list_value_length(tokens).cast(pa.int32()), count_batch(tokens)], names=["dl", "terms"])


def ngram_batch(tokens: pa.Array, max_order: int) -> pa.Array:
    """The tokens of each list, then its pairs, then its triples, joined by ``_``; every distinct n-gram is spelled once."""
    codes, words, sizes = coded(tokens)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    parts, meant, spelled, places = [(rows, codes)], [words], words, codes
    for order in range(2, max_order + 1):
        # Places whose n-gram ends in the same list.
        at = np.flatnonzero(rows[order - 1 :] == rows[: max(len(rows) - order + 1, 0)])
        pairs = pa.array(places[at] * len(words) + codes[at + order - 1]).dictionary_encode()
        head, tail = np.divmod(pairs.dictionary.to_numpy(), max(len(words), 1))
        spelled = pc.binary_join_element_wise(spelled.take(pa.array(head)), words.take(pa.array(tail)), "_", null_handling="skip")
        places = np.zeros(len(codes), np.int64)
        places[at] = pairs.indices.to_numpy()
        parts.append((rows[at], places[at] + sum(map(len, meant))))
        meant.append(spelled)
    each = [np.bincount(r, minlength=len(sizes)) for r, _ in parts]
    total = sum(each)
    out, start = np.empty(total.sum(), np.int64), np.cumsum(total) - total
    for (r, c), n in zip(parts, each):
        out[np.arange(len(r)) + np.repeat(start - (np.cumsum(n) - n), n)] = c
        start = start + n
    return listed(out, pa.concat_arrays(meant), total, tokens)


def grams_of(word: str, n_min: int, n_max: int, pad: str, whole_short: bool) -> list[str]:
    """Substrings of the padded word by length; a short one whole, if asked."""
    padded = pad + word + pad
    short = [padded] if whole_short and len(padded) < n_min else []
    return short + [padded[i : i + n] for n in range(n_min, n_max + 1) for i in range(len(padded) - n + 1)]


def _cut(words: pa.Array, n_min: int, n_max: int, pad: str, whole_short: bool) -> tuple[pa.Array, np.ndarray]:
    """``grams_of`` all words, one after the other, and how many each has; substrings are copied by their bytes."""
    padded = pc.binary_join_element_wise(pad, words, pad, "")
    data = np.frombuffer(b"".join(pc.cast(padded, pa.binary()).to_pylist()), np.uint8)
    # The first byte of each character, and the end.
    starts = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
    length = pc.utf8_length(padded).to_numpy().astype(np.int64)
    lengths = np.arange(n_min, n_max + 1)
    each = np.maximum(length[:, None] - lengths + 1, 0)
    size = np.broadcast_to(lengths, each.shape)
    if whole_short:
        each, size = np.column_stack([length < n_min, each]), np.column_stack([length, size])
    groups, first = each.ravel(), np.repeat(np.cumsum(length) - length, each.shape[1])
    start = np.arange(groups.sum()) + np.repeat(first - (np.cumsum(groups) - groups), groups)
    begin, end = starts[start], starts[start + np.repeat(size.ravel(), groups)]
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    out = data[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], end - begin)]
    made = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out))
    return made, each.sum(axis=1)


def gram_batch(words: pa.Array, n_min: int, n_max: int, pad: str, whole_short: bool) -> pa.Array:
    """Character n-grams of the words of each list; every distinct word is cut once."""
    codes, meant, sizes = coded(words)
    made = [_cut(meant.slice(k, CUT_WORDS), n_min, n_max, pad, whole_short) for k in range(0, len(meant), CUT_WORDS)]
    grams = pa.chunked_array([g for g, _ in made], pa.string()).dictionary_encode().combine_chunks()
    grams = pa.concat_arrays(grams.chunks) if isinstance(grams, pa.ChunkedArray) else grams
    each = np.concatenate([np.zeros(0, np.int64), *[n for _, n in made]])
    n, start = each[codes], (np.cumsum(each) - each)[codes]
    at = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
    total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), n, minlength=len(sizes)).astype(np.int64)
    return listed(np.asarray(grams.indices)[at], grams.dictionary, total, pa.nulls(0))
