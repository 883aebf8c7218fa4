"""Boosted regression trees over counted cells, in tasks that run at once and add up their sums level by level."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

NODES = "model int, tree int, id int, prediction double, gain double, weight double, total double, left int, right int, feature int, cut int"


def boosting(n_keys: int, n_features: int, bits: int, models: list[tuple[int, int]], n_groups: int, rounds: int, early: bool, depth: int, share: float, step: float, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow with barrier=True over cells (_k*: numbers of ranges, bits each; label; _n: pairs; _n*: pairs of each group) that gives NODES.

    A model is (group, seed): it learns from the pairs of other groups. The method is that of pyspark.ml's GBTClassifier:
    logistic loss, first tree of step one, leaves are means, a share of the pairs is drawn for each tree and of the
    features for each node; with early, trees end once the loss on the group falls by less than least."""
    import math

    each, bins = 60 // bits, 1 << bits
    drawn = max(1, math.ceil(share * n_features))
    fields = [c.split()[0] for c in NODES.split(", ")]

    def receive(line, size: int) -> bytes:
        got = bytearray()
        while len(got) < size:
            piece = line.recv(min(size - len(got), 1 << 20))
            if not piece:
                raise ConnectionError("another task of the fit has ended")
            got += piece
        return bytes(got)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import secrets
        import socket

        import numpy as np
        import pyarrow as pa
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        part, tasks = context.partitionId(), len(context.getTaskInfos())
        names = [*[f"_k{i}" for i in range(n_keys)], "label", "_n", *[f"_n{i}" for i in range(n_groups)]]
        got = [[b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names] for b in batches]
        column = {c: np.concatenate([g[i] for g in got]) if got else np.zeros(0, np.int64) for i, c in enumerate(names)}
        if not np.isin(column["label"], (0, 1)).all():
            raise ValueError("labels have to be 0 or 1")
        n = len(column["label"])
        binned = np.empty((n_features, n), np.uint8)
        for f in range(n_features):
            binned[f] = (column[f"_k{f // each}"] >> (bits * (f % each))) & (bins - 1)
        y, every = column["label"].astype(np.float64) * 2 - 1, np.arange(n)
        held = [column[f"_n{g}"] for g, _ in models]
        score = [np.zeros(n) for _ in models]
        best, kept, live = [math.inf] * len(models), [0] * len(models), list(range(len(models)))
        out = []

        # Spark's own exchange of messages takes a second each, so it only tells where the first task listens
        key, host = secrets.token_bytes(16), context.getTaskInfos()[0].address.rsplit(":", 1)[0]
        door = socket.create_server((host, 0), backlog=tasks) if part == 0 and tasks > 1 else None
        if tasks > 1:
            port, key = context.allGather(f"{door.getsockname()[1]} {key.hex()}" if door else "")[0].split()
            key = bytes.fromhex(key)
        others = {}
        if door:
            door.settimeout(300)
            while len(others) < tasks - 1:
                line, _ = door.accept()
                line.settimeout(300)
                said = receive(line, 20)
                if said[:16] == key:
                    others[int.from_bytes(said[16:], "big")] = line
        elif tasks > 1:
            others[0] = socket.create_connection((host, int(port)), 300)
            others[0].sendall(key + part.to_bytes(4, "big"))
        for line in others.values():
            line.settimeout(None)
            line.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

        def total(x):
            """The sum of all tasks' x, added in the order of the tasks by the first, the same in each."""
            if part == 0:
                for i in sorted(others):
                    x = x + np.frombuffer(receive(others[i], x.nbytes)).reshape(x.shape)
                for line in others.values():
                    line.sendall(x.tobytes())
                return x
            others[0].sendall(x.tobytes())
            return np.frombuffer(receive(others[0], x.nbytes)).reshape(x.shape)

        if not (total(np.array([float((column["_n"] - h).sum()) for h in held])) > 0).all():
            raise ValueError("a model has no pairs to learn from")
        for t in range(rounds):
            if not live:
                break
            rest, weight, place, trees = {}, {}, {}, {m: [] for m in live}
            for m in live:
                with np.errstate(over="ignore"):
                    rest[m] = y if t == 0 else 4 * y / (1 + np.exp(2 * y * score[m]))
                draw = np.random.default_rng([models[m][1], t, models[m][0], part])
                weight[m] = draw.binomial(column["_n"] - held[m], share).astype(np.float64)
                place[m] = np.zeros(n, np.int32)
                trees[m].append([0.0, -1.0, 0.0, 0.0, -1, -1, -1, -1])  # prediction, gain, weight, total, left, right, feature, cut
            front = {m: [0] for m in live}
            for level in range(depth):
                growing = [m for m in live if front[m]]
                if not growing:
                    break
                wide = max(len(front[m]) for m in growing)
                sums = np.zeros((len(growing), 2, n_features, wide * bins))
                for i, m in enumerate(growing):
                    slot = np.full(len(trees[m]), -1, np.int64)
                    slot[front[m]] = np.arange(len(front[m]))
                    at = slot[place[m]]
                    own = np.flatnonzero((at >= 0) & (weight[m] > 0))
                    base, w = at[own] * bins, weight[m][own]
                    g = w * rest[m][own]
                    for f in range(n_features):
                        cell = base + binned[f][own]
                        sums[i, 0, f] = np.bincount(cell, w, wide * bins)
                        sums[i, 1, f] = np.bincount(cell, g, wide * bins)
                sums = total(sums).reshape(len(growing), 2, n_features, wide, bins)
                for i, m in enumerate(growing):
                    tree, after = trees[m], []
                    for j, node in enumerate(front[m]):
                        w, g = sums[i, 0, :, j], sums[i, 1, :, j]
                        if level == 0:
                            tree[node][2:4] = [w[0].sum(), g[0].sum()]
                            tree[node][0] = tree[node][3] / tree[node][2] if tree[node][2] else 0.0
                        if not tree[node][2]:
                            continue
                        pick = np.random.default_rng([models[m][1], t, models[m][0], node]).permutation(n_features)[:drawn]
                        wl, gl = w[pick].cumsum(1)[:, :-1], g[pick].cumsum(1)[:, :-1]
                        wr, gr = tree[node][2] - wl, tree[node][3] - gl
                        fits = (wl > 0.5) & (wr > 0.5)  # weights are whole numbers
                        gain = np.where(fits, gl**2 / np.where(fits, wl, 1) + gr**2 / np.where(fits, wr, 1) - tree[node][3] ** 2 / tree[node][2], -1.0) / tree[node][2]
                        k, cut = divmod(int(gain.argmax()), bins - 1)
                        if gain[k, cut] <= 1e-12:
                            continue
                        tree[node][1], tree[node][4:] = float(gain[k, cut]), [len(tree), len(tree) + 1, int(pick[k]), cut]
                        for a, b in ((wl[k, cut], gl[k, cut]), (wr[k, cut], gr[k, cut])):
                            after.append(len(tree))
                            tree.append([float(b / a), -1.0, float(a), float(b), -1, -1, -1, -1])
                    if after:
                        left, feature, cut = (np.array([x[c] for x in tree]) for c in (4, 6, 7))
                        fresh = np.isin(np.arange(len(tree)), front[m]) & (left >= 0)
                        here = place[m]
                        value = binned[feature[here].clip(0), every]
                        place[m] = np.where(fresh[here], left[here] + (value > cut[here]), here).astype(np.int32)
                    front[m] = after
            loss = np.zeros((len(live), 2))
            for i, m in enumerate(live):
                score[m] = score[m] + (1.0 if t == 0 else step) * np.array([x[0] for x in trees[m]])[place[m]]
                loss[i] = [float((held[m] * 2 * np.logaddexp(0, -2 * y * score[m])).sum()), float(held[m].sum())]
                out += [(m, t, i, *x) for i, x in enumerate(trees[m])]
            if not early:
                kept = [t + 1] * len(models)
                continue
            loss = total(loss)
            for i, m in enumerate(list(live)):
                now = loss[i, 0] / loss[i, 1] if loss[i, 1] else math.inf
                if loss[i, 1] and t and best[m] - now < least * max(now, 0.01):
                    live.remove(m)
                else:
                    best[m], kept[m] = now, t + 1
        for line in [*others.values(), *([door] if door else [])]:
            line.close()
        rows = [r for r in out if r[1] < kept[r[0]]] if part == 0 else []
        kinds = [pa.int32()] * 3 + [pa.float64()] * 4 + [pa.int32()] * 4
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=fields)

    return run
