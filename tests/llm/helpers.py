"""Small inputs and brute-force versions that the operators are tested against."""

import zlib
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return (text or "").encode().translate(UPPER).split()


def shingle_set(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def near_components(docs, percent=85):
    """{doc_id: (set size, smallest reachable id)} by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def dedup_lines(docs, min_docs=3, min_chars=20):
    """{doc_id: (lines, dropped, text)}."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})

    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def read(path, name):
    import pyarrow.parquet as pq
    return pq.read_table(f"{path}/{name}.parquet").to_pylist()
