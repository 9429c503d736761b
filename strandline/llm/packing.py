"""Documents -> containers of fixed capacity with little unused space: vector bin packing.

A document has three sizes: tokens, one segment, and tokens that bear loss; a
container has a limit for each.  Containers are filled one after the other; into
the open one goes, of all documents that fit, the one whose sizes have the
largest dot product with what the container has left, each dimension weighted by
its average demand.  Documents are whole unless they alone exceed the capacity;
the largest size there is; those are cut into pieces of it, and what is left over
of them is packed like a document.  A document above the usual capacity opens a
container of the smallest size that holds it, which is filled up with others.

Documents are spread by a hash into cells of about ``CELL`` documents, and each
cell is packed for itself: a cell leaves about one container partly filled among
hundreds.  Each container is then given the smallest size it fits in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.tokens import VOCABULARY, frame, with_sizes
from strandline.session import width

CELL = 4096
MAX_SEGMENTS = 64
#: Share of a container's capacity that may bear loss, in the registered query.
LOSS_SHARE = 0.98
#: Most container sizes; more are refused.
MAX_SIZES = 1000

_OUT = "doc_id long, piece_no int, start_token int, end_token int, tokens int, loss_tokens int, container_id string, used_tokens int, segments int"


def pieces(doc_id: int, tokens: int, prompt: int, capacity: int) -> list[tuple]:
    """(doc_id, piece_no, start, end, tokens, loss tokens): one whole document, or pieces of the capacity and a rest."""
    out = []
    for i, lo in enumerate(range(0, tokens, capacity)):
        hi = min(lo + capacity, tokens)
        out.append((doc_id, i + 1, lo, hi, hi - lo, hi - max(lo, min(prompt, hi))))
    return out


def pack(sizes: np.ndarray, limits: np.ndarray, openers: np.ndarray | None = None) -> np.ndarray:
    """Container number of each item (rows: tokens, segments, loss tokens), by the dot-product heuristic.

    An item over a limit by itself gets a container of its own.  With ``openers``
    (which items) each container is opened by the largest of them that is left, the
    others only fill up, and what fits in none of these containers has -1.  Equal
    items are taken in their order, so the result is repeatable.
    """
    n = len(sizes)
    where = np.full(n, -1)
    weight = sizes.mean(0) / limits**2 if n else limits
    # equal items are one kind with a count: the search is over kinds
    marked = np.column_stack([sizes, np.zeros(n) if openers is None else openers])
    kinds, kind_of = np.unique(marked, axis=0, return_inverse=True)
    kind_of = kind_of.ravel()
    kinds, opens = kinds[:, :-1], kinds[:, -1] > 0
    order = np.argsort(kind_of, kind="stable")
    left = np.bincount(kind_of, minlength=len(kinds))
    nxt = np.concatenate([[0], np.cumsum(left)[:-1]]) if n else left
    alive = np.arange(len(kinds))
    box = 0
    while len(alive):
        room = limits.copy()
        filled = False
        if openers is not None:
            first = alive[opens[alive]]
            if not len(first):
                break
            i = first[kinds[first, 0].argmax()]
            where[order[nxt[i]]] = box
            nxt[i] += 1
            left[i] -= 1
            room, filled = room - kinds[i], True
            alive = alive[left[alive] > 0]
        while True:
            k = kinds[alive]
            fits = (k <= room).all(1)
            if not fits.any():
                if not filled:  # only items over a limit are left: each by itself
                    i = alive[0]
                    where[order[nxt[i]]] = box
                    nxt[i] += 1
                    left[i] -= 1
                break
            score = np.where(fits, k @ (weight * room), -1.0)
            i = alive[int(score.argmax())]
            where[order[nxt[i]]] = box
            nxt[i] += 1
            left[i] -= 1
            room = room - kinds[i]
            filled = True
            if not left[i]:
                alive = alive[left[alive] > 0]
                if not len(alive):
                    break
        alive = alive[left[alive] > 0]
        box += 1
    return where


def fill_containers(
    documents: DataFrame,
    sizes: DataFrame,
    container: str = "medium",
    max_segments: int = MAX_SEGMENTS,
    max_loss_share: float = 1.0,
    vocabulary: str = VOCABULARY,
    cell: int = CELL,
) -> DataFrame:
    """(doc_id, text), (container, capacity_tokens) -> one row per document or piece with its container.

    Columns: doc_id, piece_no, start_token, end_token, tokens, loss_tokens,
    container_id, used_tokens, segments, container, capacity_tokens.  Containers are
    filled up to the capacity of ``container``, to ``max_segments`` documents, and to
    ``max_loss_share`` of the capacity in loss-bearing tokens; a document over that
    limit alone gets a container of its own, since it must stay whole.  Documents
    above that capacity are whole in the smallest larger size that holds them, and
    cut only above the largest.  Null and empty texts have no tokens and no row.
    The same doc_id twice is packed twice.
    """
    rows = sizes.filter("container is not null and capacity_tokens > 0").limit(MAX_SIZES + 1).collect()
    if len(rows) > MAX_SIZES:
        raise ValueError(f"more than {MAX_SIZES} container sizes")
    kinds = {r.container: r.capacity_tokens for r in rows}
    if container not in kinds:
        raise ValueError(f"no container {container!r}")
    capacity = kinds[container]
    larger = sorted({c for c in kinds.values() if c > capacity})
    largest = max([capacity, *larger])
    docs = documents.select("doc_id", "text").filter("doc_id is not null and text <> ''")
    # all rows are counted, from the footers of the files: the number of cells needn't be exact
    cells = max(1, -(-documents.select(F.lit(1)).count() // cell))

    # ids and sizes travel, texts stay where they are read
    sized = with_sizes(docs, "text", vocabulary).filter("tokens > 0")
    sized = sized.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(cells)))
    sized = sized.repartition(width(sized), "cell").sortWithinPartitions("cell", "doc_id", "tokens")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from strandline.operators.aligner import whole_groups

        for number, g in whole_groups(batches, "cell"):
            items = [p for d, t, q in zip(g["doc_id"], g["tokens"], g["prompt_tokens"]) for p in pieces(int(d), int(t), int(q), largest)]
            s = np.array([(p[4], 1, p[5]) for p in items], float)
            where, boxes = np.full(len(items), -1), 0
            # the largest size first: what it is opened by fits no smaller one
            for below, limit in reversed(list(zip([capacity, *larger], larger))):
                todo = (where < 0).nonzero()[0]
                got = pack(s[todo], np.array([limit, max_segments, max_loss_share * limit]), s[todo, 0] > below)
                where[todo] = np.where(got >= 0, got + boxes, -1)
                boxes = int(where.max()) + 1
            todo = (where < 0).nonzero()[0]
            where[todo] = pack(s[todo], np.array([capacity, max_segments, max_loss_share * capacity])) + boxes
            used = np.bincount(where, weights=s[:, 0]).astype(int)
            segments = np.bincount(where)
            rows = [(*p, f"{number}-{b}", int(used[b]), int(segments[b])) for p, b in zip(items, where)]
            yield frame(rows, [c.split()[0] for c in _OUT.split(", ")])

    packed = sized.select("cell", "doc_id", "tokens", "prompt_tokens").mapInPandas(run, _OUT)
    # the smallest size a container's content fits in
    fitting = sorted((c, k) for k, c in kinds.items())
    name = F.coalesce(*[F.when(F.col("used_tokens") <= c, F.lit(k)) for c, k in fitting])
    size = F.coalesce(*[F.when(F.col("used_tokens") <= c, F.lit(c)) for c, k in fitting])
    return packed.withColumns({"container": name, "capacity_tokens": size})


def fill_report(packed: DataFrame) -> DataFrame:
    """Per container size: containers, tokens used, and the share of space unused."""
    boxes = packed.groupBy("container_id", "container", "capacity_tokens").agg(F.sum("tokens").alias("used"))
    return boxes.groupBy("container", "capacity_tokens").agg(
        F.count("*").alias("containers"),
        F.sum("used").alias("tokens"),
        (1 - F.sum("used") / F.sum("capacity_tokens")).alias("unused_share"),
    )
