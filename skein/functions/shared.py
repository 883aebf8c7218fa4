"""The best candidates by shared keys, of Arrow tables of entities with their keys and of keys with their candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs of an entity's key and a candidate that are held at once.
MOST_MET = 1 << 21


def best_shared(k: int, rank: str, score: str):
    """A function of two tables, (s1_id, keys, weights) and (key, wide, ids), that gives (s1_id, cand_id, rank, score) of the k best candidates of each entity.

    A score is the sum of the weights of the keys that list the candidate, apart for wide keys; a key or an id that is
    repeated counts as often. Scores equal in millionths go by cand_id."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, int),) * 3 + (np.zeros(0),)]
        s1, flat = left["s1_id"].combine_chunks(), pc.list_flatten(right["ids"])
        coded = pa.chunked_array(flat.chunks, pa.string()).combine_chunks().dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy()
        order = pc.sort_indices(names.cast(pa.binary())).to_numpy().astype(np.int64)
        places = np.empty(len(order), np.int64)
        places[order] = np.arange(len(order))
        ids, n = places[codes] + right["wide"].to_numpy().astype(np.int64).repeat(pc.list_value_length(right["ids"]).to_numpy()) * len(order), 2 * len(order)
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(right["ids"]).to_numpy())]).astype(np.int64)
        key = pc.index_in(pc.list_flatten(left["keys"]), value_set=right["key"].combine_chunks())
        known = pc.is_valid(key).to_numpy()
        key, weight = pc.fill_null(key, 0).to_numpy()[known], pc.list_flatten(left["weights"]).to_numpy()[known]
        owner = np.repeat(np.arange(len(left)), pc.list_value_length(left["keys"]).to_numpy())[known]
        sizes = at[key + 1] - at[key]
        ends = np.cumsum(np.bincount(owner, sizes, len(left))).astype(np.int64)
        x = 0
        while x < len(left):
            y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + MOST_MET, "right")))
            a, b = np.searchsorted(owner, [x, y])
            size = sizes[a:b]
            met = np.repeat(at[key[a:b]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            pairs, back = np.unique(np.repeat(owner[a:b], size) * n + ids[met], return_inverse=True)
            sums = np.bincount(back, np.repeat(weight[a:b], size), len(pairs))
            row, cand = pairs // max(n, 1), pairs % max(n, 1) % max(len(order), 1)
            best = np.lexsort((cand, -np.floor(sums * 1e6 + 0.5), row))
            row = row[best]
            place = np.arange(len(row)) - np.searchsorted(row, row) + 1
            keep = place <= k
            found.append((row[keep], cand[best][keep], place[keep], sums[best][keep]))
            x = y
        row, cand, place, sums = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table({"s1_id": s1.take(pa.array(row)), "cand_id": names.take(pa.array(order[cand])), rank: pa.array(place, pa.int32()), score: sums})

    return run
