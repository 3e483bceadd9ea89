import random

import numpy as np
import xxhash
from data import SF, frame, texts

from punctata.llm import simhash


def slow_fingerprint(text: str, width: int = 3) -> int:
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows: list[tuple]) -> list[tuple]:
    fps = [slow_fingerprint(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, f"{fps[i]:016x}", least.get(find(i))) for i, (k, _) in enumerate(rows)]


def test_simhash(spark):
    for docs in (frame(spark, texts()), spark.read.parquet(f"{SF}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = [tuple(r) for r in simhash.simhash_components(docs).collect()]
        assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def test_links_of_planted_bits(spark):
    """Fingerprints one, two and three flips away from others, chains among them."""
    r = random.Random(5)
    fps = []
    for _ in range(60):
        x = r.getrandbits(64)
        fps.append(x)
        for _ in range(r.randint(0, 5)):
            for b in r.sample(range(64), r.randint(1, 3)):
                x ^= 1 << b
            fps.append(x)
    fps += [0, 1, 3, 7 << 60]
    hub = r.getrandbits(64)
    fps += [hub ^ 1 << i ^ 1 << j for i in range(24) for j in range(i)]  # one large cell
    fps = sorted(set(fps))
    signed = [int(x) for x in np.array(fps, np.uint64).view(np.int64)]
    got = {r.node: r.component for r in simhash.near_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 2:
                root[find(x)] = find(y)
    groups, named = {}, {}
    for x, s in zip(fps, signed, strict=True):
        groups.setdefault(find(x), []).append(s)
        named.setdefault(got.get(s, s), []).append(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, named.values()))


def test_keep_first(spark):
    docs = frame(spark, texts())
    kept = simhash.keep_first(docs, 3, 2, None)
    want = {k for k, _, c in brute([(r.doc_id, r.text) for r in docs.collect()]) if k is None or k == c}
    rows = kept.collect()
    assert kept.columns == docs.columns and {r.doc_id for r in rows} == want


def test_similar_texts(spark):
    """Near copies with edits go, whatever their bits; others and odd rows stay."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows, groups = [], []
    for g in range(40):
        base = [r.choice(words) for _ in range(r.randint(60, 400))]
        for c in range(r.randint(1, 4)):
            w = list(base)
            if c:
                for at in r.sample(range(len(w)), max(1, len(w) // 70)):
                    w[at] = "edit" + str(r.random())
            rows.append(" ".join(w))
            groups.append(g)
    passage = " ".join(r.choice(words) for _ in range(60))
    for _ in range(30):
        rows.append(" ".join(r.choice(words) for _ in range(200)) + " " + passage)
        groups.append(100 + len(rows))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(4)
    shingles = [{" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in rows)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = {i for i in range(len(rows)) if find(i) == i}
    got = {x.doc_id for x in simhash.keep_first(docs).collect()}
    assert got == want
    odd = frame(spark, texts())
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == odd.where("doc_id IS NULL").count()
    assert simhash.keep_first(odd.limit(0)).count() == 0


def similar_groups(rows: list[str], width: int = 5) -> set[int]:
    """First rows of the components of all pairs of similarity 0.8 or more, by brute force."""
    sets = []
    for t in rows:
        w = t.split()
        sets.append({" ".join(w[i : i + width]) for i in range(len(w) - width + 1)} or {" ".join(w)})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = [(i, j) for i in range(len(rows)) for j in range(i) if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    for i, j in near:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return {i for i in range(len(rows)) if find(i) == i}


def linked_groups(spark, rows: list[str], **how) -> set[int]:
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i long, text string").repartition(4).selectExpr("i", "text", "xxhash64(text) AS th")
    links = simhash.components(simhash.similar_texts(docs, 5, 0.8, **how)).withColumnRenamed("node", "th")
    named = docs.join(links, "th", "left").selectExpr("i", "coalesce(component, th) AS c")
    return {r[0] for r in named.groupBy("c").agg({"i": "min"}).select("min(i)").collect()}


def star(r: random.Random, copies: int, words: int = 400) -> list[str]:
    """An original and copies of similarity 0.84 to it and about 0.7 to one another: each has seven edits of its own."""
    base = [f"b{r.random()}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for k in range(7):
            w[57 * k + r.randint(5, 50)] = f"e{r.random()}"
        out.append(" ".join(w))
    return out


def test_star_of_copies(spark):
    """All copies meet their original; copies whose original is not there stay apart."""
    r = random.Random(3)
    one = star(r, 2000)
    rows = [*one[1:], one[0], *star(r, 40)[1:], *(f"x{r.random()} " * 30 for _ in range(20))]
    want = similar_groups(rows)
    assert len(want) < 80 and linked_groups(spark, rows) == want


def test_large_keys_are_compared_whole(spark):
    """Small windows and blocks, so that the pass over blocks has to find the links."""
    r = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for _ in range(400):
        w = list(base)
        for at in r.sample(range(60), r.randint(1, 3)):
            w[at] = f"e{r.randint(0, 9)}"
        rows.append(" ".join(w))
    rows = list(dict.fromkeys(rows))
    assert linked_groups(spark, rows, before=1, block=16) == similar_groups(rows)


def test_short_texts(spark):
    """Texts of 5 to 60 words with a word more, less or changed: every link of brute force and no other."""
    r = random.Random(6)
    rows = ["a b c d", "A b  c d", "a b c e", "a", "b"]
    for g in range(220):
        n = 5 + g % 56
        base = [f"g{g}w{i}" for i in range(n)]
        edit = list(base)
        edit[r.choice([0, n - 1])] = "edit"
        rows += [" ".join(base), " ".join([*base, "more"]), " ".join(base[1:]), " ".join(edit), " ".join([*base, "one", "two"])]
    want = similar_groups([t.lower() for t in rows])
    assert len(want) < len(rows) and linked_groups(spark, rows) == want
