"""Every operator against brute force, a round trip or held-out accuracy, and on awkward rows."""

import base64
import hashlib
import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricemill.llm import bpe, context_tree, fingerprints, html_text, language, mixing, near_duplicates, search, sharding, warc
from pricemill.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted(docs.collect(), key=lambda r: r.doc_id)


LONG = " ".join(f"word{i % 977}" for i in range(30_000))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and further columns with clashing names."""
    data = [
        (1, "", "en", "a"), (2, None, None, None), (3, LONG, "en", "a"), (4, LONG + " end", "de", None), (5, "\n \t", "en", "b"),
        (6, "same words here for all of us to read", None, "a"), (6, "same words here for all of us to read", None, "a"),
        (None, "no id but a text", "en", "b"), (8, "x" * 5000, "fr", "b"), (9, "▁ \u0000 é 日本 😀", "fr", "c"), (10, "a\nb\r\nc", "de", "c"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    extra = ("size", "id", "key", "row", "shard", "score", "bucket", "sid", "words", "tail", "range", "comp", "_value", "lang_pred")
    return df.withColumns({c: F.lit(7) for c in extra})


@pytest.fixture(scope="module")
def awkward_pages(spark):
    data = [(1, None, None), (2, "u", ""), (3, "u", "<p>x"), (3, "u", "<p>x"), (None, "v", "<p>x"), (5, "w", "<article><p>" + LONG + "</p></article>")]
    return spark.createDataFrame(data, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("row", "text", "_sha", "data")})


DOCUMENTS = {
    "fingerprints": fingerprints.fingerprint_documents, "language": language.identify_languages, "mix": mixing.mix,
    "bpe": bpe.encode_documents, "near": near_duplicates.near_duplicate_classes, "scores": context_tree.score_documents,
    "shards": sharding.shard_documents,
}


@pytest.mark.parametrize("name", DOCUMENTS)
def test_awkward_and_empty_documents(awkward, name):
    result = DOCUMENTS[name](awkward).collect()
    assert len(result) == 11
    assert DOCUMENTS[name](awkward.limit(0)).count() == 0
    if name == "bpe":
        assert all(r.lossless for r in result)
    if name == "near":
        by = {r.doc_id: (r.class_id, r.class_size) for r in result}
        assert by[3] == by[4] == (3, 2) and by[6] == (6, 2) and by[1] == by[2] == by[5] == (1, 3) and by[8] == (8, 1)
    if name == "shards":
        assert by_slots(result)
    if name == "scores":
        empty = [r for r in result if r.n_tokens == 1]
        assert len(empty) == 3 and all(r.score < 0 for r in result)


def by_slots(result) -> bool:
    slots = defaultdict(list)
    for r in result:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_searches_and_pages(awkward, awkward_pages):
    assert search.search_documents(awkward, awkward.limit(0)).count() == 0
    assert search.search_documents(awkward.limit(0), awkward).count() == 0
    found = search.search_documents(awkward, awkward).where("query_id = 6").orderBy("rank").collect()
    assert [r.doc_id for r in found][:2] == [6, 6]
    assert html_text.extract_pages(awkward_pages).count() == 6
    assert html_text.extract_pages(awkward_pages.limit(0)).count() == 0
    archived = warc.archive_pages(awkward_pages).collect()
    assert sorted(str((r.page_id, r.record_type, r.refers_to)) for r in archived) == sorted(map(str, [
        (1, "revisit", 2), (2, "response", None), (3, "revisit", 3), (3, "response", None), (None, "revisit", 3), (5, "response", None)]))
    assert warc.archive_pages(awkward_pages.limit(0)).count() == 0


def test_fingerprints(docs, rows):
    got = {r.doc_id: r for r in QUERIES["op1_document_fingerprints"](docs.sparkSession, SMALL).collect()}
    for i, row in enumerate(rows):
        following = rows[(i + 1) % len(rows)].text
        n = len(row.text) // 4
        edited = row.text[: len(row.text) - n] + following[:n] if n else row.text
        mark, r = fingerprints.Fingerprint.of(row.text), got[row.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(row.text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == mark.text() and r.edited_fingerprint == fingerprints.Fingerprint.of(edited).text()
        assert r.near_edited == mark.likeness(fingerprints.Fingerprint.of(edited))
    assert np.mean([r.near_edited for r in got.values()]) > 0.6 > 0.2 > np.mean([r.near_next for r in got.values()])


def test_fingerprints_are_homomorphic():
    of = fingerprints.Fingerprint.of
    lines = ["one line of text", "another, longer line of the same text", "x"]
    whole = of("\n".join(lines))
    assert whole.text() == of("\n".join(reversed(lines))).text()
    assert whole.text() == of(lines[0]).insert(of(lines[1])).insert(of(lines[2])).text()
    assert whole.delete(of(lines[1])).text() == of(lines[0] + "\n" + lines[2]).text()
    assert whole.text() != of("\n".join(lines[:2])).text()


def test_language_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op2_language_id"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    right = np.mean([langs[r.doc_id] == r.lang_pred for r in held])
    assert right > 0.98 and abs(right - np.mean([r.score for r in held])) < 0.05


def permuted(x: int, n: int, *salt) -> int:
    high = math.ceil(math.sqrt(n))
    wide = math.ceil(n / high)
    while True:
        a, b = divmod(x, wide)
        for kind in range(4):
            key = ":".join(map(str, [mixing.SEED, *salt, kind, a if kind % 2 else b]))
            if kind % 2:
                b = (b + zlib.crc32(key.encode())) % wide
            else:
                a = (a + zlib.crc32(key.encode())) % high
        x = a * wide + b
        if x < n:
            return x


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 50, 1000):
        assert sorted(permuted(x, n, "s") for x in range(n)) == list(range(n))
        got = spark.range(n).select(mixing.permutation(F.col("id"), F.lit(n).cast("long"), F.lit("s")).alias("p")).collect()
        assert [r.p for r in got] == [permuted(x, n, "s") for x in range(n)]


def test_mix_equals_brute_force(docs, rows):
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    size = {r.doc_id: len([w for w in r.text.encode().split()]) for r in rows}
    sources = sorted({r.source for r in rows})
    total = {s: sum(size[r.doc_id] for r in rows if r.source == s) for s in sources}
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while True:  # cut what is above twice its size, share the rest anew
        left = 1.5 * sum(total.values()) - sum(target.values())
        level = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = [s for s in open_ if level[s] > 2 * total[s]]
        if not above:
            break
        for s in above:
            target[s] = 2.0 * total[s]
            open_.discard(s)
    target |= level
    for sid, s in enumerate(sources, 1):
        stream = [r.doc_id for r in rows if r.source == s for _ in range(size[r.doc_id])]
        passes, rest = divmod(math.floor(target[s] + 0.5), len(stream))
        full, taken = len(stream) // mixing.BLOCK, Counter({d: passes * n for d, n in Counter(stream).items()})
        for k in range(math.ceil(rest / mixing.BLOCK)):
            block = permuted(k, full, sid, passes) if k < full else full
            words = min(mixing.BLOCK, rest - k * mixing.BLOCK)
            taken.update(stream[block * mixing.BLOCK :][:words])
        for r in rows:
            if r.source == s:
                mine = got[r.doc_id]
                assert (mine.size, mine.source_size, mine.taken) == (size[r.doc_id], total[s], taken[r.doc_id])
                assert mine.target == pytest.approx(target[s])
    pieces = mixing.mixed_documents(docs).collect()
    assert sum(len(r.text.encode().split()) for r in pieces) == sum(r.taken for r in got.values())


def test_mix_has_shards_of_interleaved_blocks(docs, awkward, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 128)
    source = {r.doc_id: r.source for r in docs.collect()}
    pieces = mixing.mixed_documents(docs).collect()
    slots = defaultdict(list)
    for r in pieces:
        slots[r.mix_shard, r.mix_slot].append((r.mix_at, len(r.text.encode().split()), r.source))
    shards = defaultdict(list)
    for (shard, slot), found in sorted(slots.items()):
        at = 0
        for begin, n, _ in sorted(found):
            assert begin == at
            at += n
        assert at <= mixing.BLOCK and len({s for _, _, s in found}) == 1
        shards[shard].append((slot, found[0][2]))
    # shards are full but for the last one; in each the sources' counts follow the totals, and their blocks alternate
    assert sorted(shards) == list(range(len(shards))) and len(shards) > 2
    drawn = Counter(s for found in shards.values() for _, s in found)
    total = sum(drawn.values())
    for shard, found in shards.items():
        assert [slot for slot, _ in found] == list(range(len(found))) and (len(found) == 128 or shard == len(shards) - 1)
        here = Counter(s for _, s in found)
        for s, n in drawn.items():
            share = n / total
            assert abs(here[s] - share * len(found)) < 5 * math.sqrt(share * (1 - share) * len(found)) + 1
        if len(found) == 128:
            assert sum(a[1] != b[1] for a, b in zip(found, found[1:])) > 2 * len(here)
    spans = Counter()
    for r in mixing.mix(docs).collect():
        assert sum(p.to - p["from"] for p in r.spans) == r.taken
        spans.update((source[r.doc_id], p.shard, p.slot, p.at) for p in r.spans)
    assert spans == Counter((r.source, r.mix_shard, r.mix_slot, r.mix_at) for r in pieces)
    # repeated rows, rows without doc_id, source or text
    taken = sum(r.taken for r in mixing.mix(awkward).collect())
    rows = mixing.mixed_documents(awkward)
    assert rows.columns == [*awkward.columns, *mixing.PLACE]
    assert sum(len(r.text.encode().split()) for r in rows.collect()) == taken > 0
    assert mixing.mixed_documents(awkward.limit(0)).count() == 0


def test_drawn_blocks_are_dealt_and_not_broadcast(docs):
    """The draws grow with the words: they meet the documents in a merge join, and no single task spells them all out."""
    sized = mixing.sized_documents(docs)
    sources = mixing.source_targets(sized)
    placed = mixing.place_documents(sized, sources, 1000, [F.col("doc_id")])
    met = mixing.pieces_of(placed, mixing.draws(sources))
    met.collect()
    text = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above = text[: text.index("sid#", text.index("SortMergeJoin"))] if "SortMergeJoin" in text else text
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in above
    assert "Exchange RoundRobinPartitioning" in text


def test_bpe_equals_the_library_and_decodes(docs, rows):
    import sentencepiece

    model = open(bpe.MODEL_FILE, "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_file=bpe.MODEL_FILE)
    plain, dropping = bpe.Encoder(model, 0.0), bpe.Encoder(model)
    texts = [r.text for r in rows] + ["  two  spaces ", "tab\t\nline\r\n", "日本 😀", "<0x41> </s>", "a" * 200]
    assert [t.tolist() for t in plain.encode(texts, [0] * len(texts))] == library.encode(texts)
    chunks = sorted({c for t in texts for c in bpe.CHUNK.findall(" " + t)})
    ids, begin = dropping.merge_all(chunks, np.array([dropping.chunk_key(c, 2) for c in chunks], np.uint64))
    assert all(ids[begin[i] : begin[i + 1]].tolist() == dropping.agenda(c, 2) for i, c in enumerate(chunks))
    got = {r.doc_id: r for r in bpe.encode_documents(docs).collect()}
    again = {r.doc_id: r.token_ids for r in bpe.encode_documents(docs.repartition(3)).collect()}
    assert all(r.lossless and again[d] == r.token_ids for d, r in got.items())
    assert all(dropping.decode(got[r.doc_id].token_ids) == r.text for r in rows)
    assert sum(r.n_tokens for r in got.values()) > sum(map(len, library.encode([r.text for r in rows])))


def test_every_place_of_a_word_is_segmented_by_its_own_key():
    model = open(bpe.MODEL_FILE, "rb").read()
    plain, dropping = bpe.Encoder(model, 0.0), bpe.Encoder(model)
    words = [" international", " segmentation", " a", "b", " \u2581日本"]
    word = np.arange(4000) % len(words)
    places = np.arange(4000, dtype=np.uint64) * np.uint64(bpe.K1)
    crc = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    ids, first, size = dropping.segment_all(words, word, dropping.chunk_keys(crc[word], places))
    for i, w in enumerate(word.tolist()):
        assert ids[first[i] : first[i] + size[i]].tolist() == dropping.agenda(words[w], int(places[i]))
    # one frequent word is segmented in more than a few fixed ways
    found = Counter(tuple(t.tolist()) for t in dropping.encode(["international"] * 5000, list(range(5000))))
    assert len(found) > 8 and found.most_common(1)[0][0] == tuple(plain.encode(["international"], [5])[0].tolist())


def test_places_of_seldom_words_are_merged_once_and_not_kept(monkeypatch):
    dropping, merged = bpe.Encoder(open(bpe.MODEL_FILE, "rb").read()), []
    merge_all = dropping.merge_all
    monkeypatch.setattr(dropping, "merge_all", lambda chunks, *rest: merged.extend(chunks) or merge_all(chunks, *rest))
    words = [f" word{i}segmentation" for i in range(2000)]
    word = np.append(np.arange(2000), np.arange(500))
    keys = dropping.chunk_keys(np.array([zlib.crc32(words[w].encode()) for w in word], np.uint64), np.arange(2500, dtype=np.uint64))
    ids, first, size = dropping.segment_all(words, word, keys)
    for i, w in enumerate(word.tolist()):
        assert ids[first[i] : first[i] + size[i]].tolist() == dropping.agenda(words[w], i)
    assert len(merged) == 2500 and not dropping.known
    # a word of many places is kept, and its one place in the next batch starts from there
    dropping.segment_all(words, np.zeros(9, np.int64), keys[:9])
    assert list(dropping.known) == words[:1]
    ids, first, size = dropping.segment_all(words, np.zeros(1, np.int64), keys[:1])
    assert ids[first[0] : first[0] + size[0]].tolist() == dropping.agenda(words[0], 0)


def test_chunks_of_bytes_are_those_of_the_pattern():
    texts = ["", " ", "\n", "a", " a  b ", "a\n\nb\n", "\n a", "日本 😀  \u2581x\n", "tab\t \r\n ", "   ", "", "end"]
    chunks, sizes = bpe._cut([t.encode() for t in texts])
    assert [c.decode() for c in chunks.to_pylist()] == [c for t in texts for c in bpe.CHUNK.findall(t)]
    assert sizes.tolist() == [len(bpe.CHUNK.findall(t)) for t in texts]
    chunks, sizes = bpe._cut([b"", b""])
    assert len(chunks) == 0 and sizes.tolist() == [0, 0]


def test_near_duplicates_equal_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    hasher = near_duplicates.Hasher()
    marks = {r.doc_id: set(near_duplicates.labelled(hasher.kmers(near_duplicates.words_of(r.text))).tolist()) for r in texts}
    root = {d: d for d in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(marks)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            n, m = len(marks[a]), len(marks[b])
            if min(n, m) >= 0.8 * max(n, m):
                common = len(marks[a] & marks[b])
                if common >= 0.8 * (n + m - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert got == {d: find(d) for d in ids}


def test_a_large_group_of_near_copies(spark):
    """Copies with up to a few edits each: in one class if they are near enough to any other, and classes are found across blocks."""
    base = [f"w{i}" for i in range(120)]
    made = []
    for d in range(700):
        words = list(base)
        for e in range(d % 5):
            words[(d * 7 + e * 31) % 120] = f"x{d}_{e}"
        made.append((d, " ".join(words)))
    df = spark.createDataFrame(made, "doc_id long, text string")
    hasher = near_duplicates.Hasher()
    marks = [near_duplicates.labelled(hasher.kmers(near_duplicates.words_of(t))) for _, t in made]
    near = {d: near_duplicates.similarity(marks[0], marks[d]) >= 0.8 for d in range(700)}
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicate_classes(df).collect()}
    assert all(got[d] == 0 for d in near if near[d])


def test_one_row_of_every_class(spark, awkward):
    """Repeated and missing doc_ids: unlike texts stay, whatever the order; of a class one row stays."""
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"]
    made = [
        (3, texts[0]), (7, texts[0]), (7, texts[1]), (7, texts[2]), (7, texts[2]), (None, texts[3]), (None, texts[4]), (None, texts[2]),
        (None, texts[4]), (None, None), (9, ""), (None, texts[5] + " more"), (None, texts[5]),
    ]
    want = {(3, texts[0]), (7, texts[1]), (7, texts[2]), (None, texts[3]), (None, texts[4]), (9, "")}
    seen = set()
    for data in (made, made[::-1]):
        df = spark.createDataFrame(data, "doc_id long, text string").repartition(3 if data is made else 1)
        got = [tuple(r) for r in near_duplicates.one_of_each(df).collect()]
        assert len(got) == 7 and want < set(got)
        seen.add(frozenset(got))
    assert len(seen) == 1
    single = near_duplicates.one_of_each(awkward)
    assert single.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in single.collect()) == ["1", "10", "3", "6", "8", "9", "None"]
    assert near_duplicates.one_of_each(awkward.limit(0)).count() == 0


def test_awkward_rows_through_the_language_stage(awkward):
    kept = language.known_language(awkward)
    assert kept.columns == awkward.columns
    found = Counter(r.doc_id for r in kept.collect())
    assert not found.keys() & {1, 2, 5} and found[6] in (0, 2) and all(n == 1 for d, n in found.items() if d != 6)
    assert language.known_language(awkward.limit(0)).count() == 0


def test_context_tree(docs, rows):
    counts = Counter()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 5 != 1:
            counts.update([*context_tree.words_of(r.text), b""])
    total, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in context_tree.score_documents(docs).collect()}
    for r in rows:
        tokens, mine = [*context_tree.words_of(r.text), b""], got[r.doc_id]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        assert (mine.n_tokens, mine.n_known, mine.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert mine.base_score == pytest.approx(base) and mine.score < 0
        assert mine.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)


def test_context_tree_weights_by_definition():
    """Mixture over depths against the recursive definition, on a tree whose contexts are all kept."""
    streams = [b"abracadabra\0", b"abacab\0", b"bacada\0"]
    codes, _ = context_tree.codes_of(streams)
    levels = []
    for d in range(context_tree.DEPTH + 1):
        grams = codes >> np.uint64(8 * (context_tree.DEPTH - d))
        contexts, at = np.unique(grams & np.uint64((1 << 8 * d) - 1), return_inverse=True)
        table = np.zeros((len(contexts), 256))
        np.add.at(table, (at, (grams >> np.uint64(8 * d)).astype(int)), 1)
        levels.append((contexts, table))
    model = context_tree.Model.of(levels)
    seen = [[(c >> (8 * (context_tree.DEPTH - d)) & (1 << 8 * d) - 1, c >> 8 * context_tree.DEPTH) for c in codes.tolist()] for d in range(context_tree.DEPTH + 1)]

    def counted(d, context, prefix, level):
        bits = [b >> (7 - level) & 1 for s, b in seen[d] if s == context and b >> (8 - level) == prefix]
        return bits.count(0), bits.count(1)

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_weighted(d, context, prefix, level):
        own = log_kt(*counted(d, context, prefix, level))
        if d == context_tree.DEPTH:
            return own
        below = {s for s, _ in seen[d + 1] if s >> 8 == context}
        return np.logaddexp(own, sum(log_weighted(d + 1, s, prefix, level) for s in below)) - math.log(2)

    for code in sorted(set(codes.tolist()))[:6]:
        byte, want = code >> 8 * context_tree.DEPTH, 0.0
        for level in range(8):
            prefix, bit, p, left = byte >> (8 - level), byte >> (7 - level) & 1, 0.0, 1.0
            for d in range(context_tree.DEPTH + 1):
                context = code >> 8 * (context_tree.DEPTH - d) & (1 << 8 * d) - 1
                a, b = counted(d, context, prefix, level)
                weight = 1.0 if d == context_tree.DEPTH else math.exp(log_kt(a, b) - math.log(2) - log_weighted(d, context, prefix, level))
                p += left * weight * (b + 0.5) / (a + b + 1)
                left *= 1 - weight
            want += math.log(p if bit else 1 - p)
        assert model.log_probabilities(np.array([code], np.uint64))[0] == pytest.approx(want, rel=1e-4)
    # a distribution: the probabilities of all bytes after a context add up to one
    every = (codes[:1] & np.uint64((1 << 40) - 1)) | np.arange(256, dtype=np.uint64) << np.uint64(40)
    assert np.exp(model.log_probabilities(every)).sum() == pytest.approx(1, abs=1e-4)


def test_scores_use_every_context(spark, monkeypatch):
    """A rare context in a corpus of over 131,072 bytes, and codes that are not sent to the tasks, against the tree in one process."""
    monkeypatch.setattr(context_tree, "HOT", 40)
    monkeypatch.setattr(context_tree, "SLICE", 64)
    common = " ".join(f"{w}{i % 37}" for i in range(900) for w in ("alpha", "beta", "gamma"))
    made = [(i, common) for i in range(12)] + [(20, "zq7 xkcd"), (21, "zq7 xkcd"), (22, "zq7 xk!"), (23, None)]
    got = {r.doc_id: r for r in context_tree.score_documents(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    streams = {d: b" ".join(context_tree.words_of(t)) + b"\0" for d, t in made}
    learnt, n = np.unique(context_tree.codes_of([s for d, s in streams.items() if not got[d].held_out])[0], return_counts=True)
    assert n.sum() > 131_072 and any(got[d].held_out for d in streams) and not (got[20].held_out and got[21].held_out)
    model = context_tree.Model(learnt.astype(np.int64), n)
    for d, s in streams.items():
        assert got[d].score == pytest.approx(model.log_probabilities(context_tree.codes_of([s])[0]).sum() / math.log(10))


def test_search_equals_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", sum(len(r.text or "") for r in rows) // 4)
    counted = {r.doc_id: Counter(search.terms_of(r.text)) for r in rows}
    having = Counter(t for c in counted.values() for t in c)
    mean = sum(sum(c.values()) for c in counted.values()) / len(counted)
    got = defaultdict(list)
    for r in search.search_every_20th(docs).collect():
        got[r.query_id].append((r.rank, r.doc_id))
    for q in (d for d in counted if d % 20 == 0):
        scored = []
        for d, c in counted.items():
            norm = search.K1 * (1 - search.B + search.B * sum(c.values()) / mean)
            s = sum(search.idf(len(counted), having[t]) * c[t] * (search.K1 + 1) / (c[t] + norm) for t in counted[q] if t in c)
            if s > 0:
                scored.append((-round(s, search.DIGITS), d))
        assert [d for _, d in sorted(got[q])] == [d for _, d in sorted(scored)[: search.TOP]]


def test_rows_to_merge_grow_with_the_queries_and_not_with_the_shards(docs, rows, monkeypatch):
    """Shards of a few documents, and queries that more than one task holds."""
    made, real = docs.sparkSession.sparkContext.accumulator(0), search._searched

    def counted(*args):
        run = real(*args)

        def counting(batches):
            for batch in run(batches):
                made.add(batch.num_rows)
                yield batch

        return counting

    expected = sorted(search.search_every_20th(docs).collect())
    queries = sum(r.doc_id % 20 == 0 for r in rows)
    monkeypatch.setattr(search, "_searched", counted)
    monkeypatch.setattr(search, "HELD_BYTES", 2000, raising=False)
    monkeypatch.setattr(search, "FEW", 2, raising=False)
    monkeypatch.setattr(search, "SEARCHERS", 3, raising=False)
    monkeypatch.setattr(search, "SHARD_BYTES", sum(len(r.text or "") for r in rows) // 24)
    assert sorted(search.search_every_20th(docs).collect()) == expected
    assert search.TOP * queries <= made.value <= 3 * search.TOP * queries


def test_queries_answered_together_have_the_results_of_one_by_one(monkeypatch):
    """Two vocabularies, so that tiles are left out; copies, that tie; documents without an id or a word; queries without a known term."""
    rng, head, flat, texts = np.random.default_rng(11), [], [], []
    share = 1 / np.arange(1, 401)
    for i in range(1500):
        text = Counter((400 * (i % 2) + rng.choice(400, i % 97, p=share / share.sum())).tolist())
        texts.append(texts[i - 40] if i % 50 == 49 else text)
        head.append((5000 - i if i % 200 != 3 else 0, i % 200 != 3, sum(texts[i].values()), len(texts[i])))
        flat += sorted(texts[i].items())
    having = Counter(t for c in texts for t in c)
    weights = np.array([search.idf(len(texts), having[t]) for t in range(800)])
    mean = sum(h[2] for h in head) / len(head)
    local, chunk = np.arange(800), search.pack(*np.array(head, np.int64).T, *np.array(flat, np.int64).T)
    index = search.Index(local, local, weights, [chunk], mean)
    queries = [np.array(sorted(c), np.int64) for c in texts[::7]] + [np.array([900, 950]), np.array([1, 2, 401, 402, 900])]
    single = [index.search(q) for q in queries]
    for seldom, dense, tile, together in ((32, 4096, 64, 1000), (4, 20, 100, 7), (10**9, 4096, 2048, 3)):
        for name, value in (("SELDOM", seldom), ("DENSE", dense), ("TILE", tile), ("TOGETHER", together)):
            monkeypatch.setattr(search, name, value)
        index.__dict__.pop("_tiles", None)
        assert list(index.search_together(queries, [0.0] * len(queries))) == single
        # with a threshold: at least all that reach it
        floors = [found[4][1] if len(found) > 4 else 0.0 for found in single]
        for found, one, floor in zip(index.search_together(queries, floors), single, floors, strict=True):
            assert [x for x in found if x[1] >= floor] == [x for x in one if x[1] >= floor]
    # a task's files, in parts of a few queries: two shards alike give each result twice
    asked, keys = search.Asked(search.TOP), [None, *range(1, len(queries))]
    for part in (slice(0, 50), slice(50, None)):
        asked.add(keys[part], [search.pack(np.diff(q, prepend=0)) for q in queries[part]])
    asked.search(index)
    asked.search(index)
    got = [tuple(r.values()) for batch in asked.rows() for r in batch.to_pylist()]
    asked.close()
    assert got == [(key, *x) for key, one in zip(keys, single, strict=True) for x in [y for y in one for _ in range(2)][: search.TOP]]


def test_an_index_is_built_within_few_bytes_per_posting():
    """Chunks with 400,000 postings, of which queries can meet two thirds."""
    rng, chunks, documents, words = np.random.default_rng(3), [], 500, 300
    for at in range(0, 4000, documents):
        terms = np.concatenate([rng.permutation(900)[: words // 3] for _ in range(documents)])
        head = [np.arange(at, at + documents), np.ones(documents), np.full(documents, words), np.full(documents, words // 3)]
        chunks.append(search.pack(*(c.astype(np.int64) for c in (*head, terms, rng.integers(1, 9, len(terms))))))
    local = np.arange(0, 900)[np.arange(900) % 3 > 0]
    tracemalloc.start()
    index = search.Index(local, local, np.ones(len(local)), chunks, float(words))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    postings = len(index.its_terms)
    assert 260_000 < postings < 275_000
    assert peak < 50 * postings


def test_search_skips_blocks_and_loses_nothing():
    """Whole texts as queries, then a seldom word with one that all texts have, whose blocks without the first are of no use."""
    rng = np.random.default_rng(5)
    words = [[f"{g}{i}" for i in range(300)] for g in "ab"]
    share = 1 / np.arange(1, 301)
    texts = [["the", *rng.choice(words[i % 2], 20 + i % 90, p=share / share.sum())] for i in range(3000)]
    number, postings = {}, []
    for text in texts:
        postings.append(sorted((number.setdefault(t, len(number)), c) for t, c in Counter(text).items()))
    counted = [dict(p) for p in postings]
    having, mean = Counter(t for c in counted for t in c), sum(map(len, texts)) / len(texts)
    chunks = []
    for part in (slice(0, 1700), slice(1700, 3000)):
        head = [range(3000)[part], [1] * len(texts[part]), [len(t) for t in texts[part]], [len(p) for p in postings[part]]]
        flat = [x for p in postings[part] for x in p]
        columns = [np.array(c, np.int64) for c in (*head, [t for t, _ in flat], [c for _, c in flat])]
        chunks.append(search.pack(*columns))
        assert all((a == b).all() for a, b in zip(columns, search.unpack(chunks[-1]), strict=True))
    order = rng.permutation(len(number))
    weights = np.array([search.idf(len(texts), having[t]) for t in order])
    index = search.Index(order, 10 * np.arange(len(order)), weights, chunks, mean)
    name = {t: 10 * i for i, t in enumerate(order.tolist())}

    def check(query):
        found = index.search(np.array(sorted([*(name[t] for t in query), 7, 10**6])))
        scored = []
        for d, c in enumerate(counted):
            norm = search.K1 * (1 - search.B + search.B * len(texts[d]) / mean)
            s = sum(search.idf(len(texts), having[t]) * c[t] * (search.K1 + 1) / (c[t] + norm) for t in query if t in c)
            scored.append((-round(s, search.DIGITS), d))
        assert found == [(d, -s) for s, d in sorted(scored)[: search.TOP] if s < 0]

    for q in range(0, 3000, 100):
        check(counted[q])
    assert index.blocks_read < index.blocks_seen
    index.blocks_read = index.blocks_seen = 0
    for t in [t for t in having if 12 <= having[t] <= 40][:20]:
        check([t, number["the"]])
    assert 0 < index.blocks_read < 0.7 * index.blocks_seen


def test_messages_give_exact_marginals():
    model = html_text.fit(html_text.label_layouts())
    tree = html_text.parse("<body><div class=ad><p>a b</p></div><article><p>some text.</p></article>")
    unary, pair, n = model.unary(tree), model.pair, len(tree.parent)
    mass = np.zeros((n, 2))
    for labels in np.ndindex(*[2] * n):
        score = sum(unary[i] * labels[i] for i in range(1, n)) + sum(pair[labels[tree.parent[i]]][labels[i]] for i in range(1, n))
        if labels[0] == 0:
            for i in range(n):
                mass[i, labels[i]] += math.exp(score)
    assert np.allclose(mass[:, 1] / mass.sum(1), model.marginals(tree), atol=1e-6)


def test_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in QUERIES["op8_html_extraction"](spark, SMALL).collect():
        tree = html_text.parse(html[r.page_id])
        inside = html_text.label_by_role(tree)
        assert r.text == " ".join(t for t, y in zip(tree.text, inside, strict=True) if t and y) and r.n_chars == len(r.text)
    page = html_text.parse("<p>a&amp;b <b>c</b>d<br>e<script>var x='<p>no'</script><li>x<li>y &copy z<!-- <p>no -->")
    assert [t for t in page.text if t] == ["a&b cd e", "x", "y © z"]


def test_bundles(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FRAME_BYTES", 5000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 20_000)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").unionByName(
        spark.read.parquet(f"{SMALL}/pages.parquet").withColumn("page_id", F.col("page_id") + 10_000))
    warc.write_bundles(pages, f"{tmp_path}/bundles")
    bundles = spark.read.parquet(f"{tmp_path}/bundles")
    html = {r.page_id: r.html.encode() for r in pages.collect()}
    records = warc.read_bundles(bundles, with_payload=True).collect()
    assert len(records) == len(html)
    for r in records:
        data = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        if r.record_type == "response":
            assert r.payload == data and r.page_id >= 10_000 and r.refers_to is None
        else:
            assert r.refers_to == r.page_id + 10_000
    # one record by its index entry, from its frame alone; and the frames are a plain Zstandard stream
    row = bundles.first()
    entry = row.records[-1]
    raw = warc.Bundle(bytes(row.data)).read(entry.frame, entry.offset, entry.length)
    assert warc.parse(raw)[0]["WARC-Record-ID"] == entry.id
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(bytes(row.data), read_across_frames=True) as stream:
        assert stream.read().count(b"WARC/1.1\r\n") == len(row.records)


def test_shards_are_the_smallest_possible(docs, rows, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)  # cells are split several times, even with few groups
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    got = sharding.shard_documents(docs).collect()
    text = {r.doc_id: r.text for r in rows}
    weight = defaultdict(int)
    shard_bytes, shard_of = defaultdict(int), {}
    for r in got:
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "bytes")
        weight[hashlib.sha256(data).hexdigest()] += r.size
        shard_bytes[r.shard] += r.size
        assert shard_of.setdefault(data, r.shard) == r.shard
    sizes = [weight[k] for k in sorted(weight)]

    def shards_for(capacity):
        n, used = 1, 0
        for s in sizes:
            if used + s > capacity:
                n, used = n + 1, 0
            used += s
        return n

    capacity = next(c for c in range(max(sizes), sum(sizes)) if shards_for(c) <= 16)
    assert max(shard_bytes.values()) == capacity and by_slots(got) and set(shard_bytes) <= set(range(16))


def test_sql_agrees(spark, duck, sf_dir):
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, sf_dir)
        cursor = duck.execute(sql)
        names = [c[0] for c in cursor.description]
        assert sorted(map(str, (tuple(r) for r in df.select(names).collect()))) == sorted(map(str, cursor.fetchall()))


def test_pipeline(spark, docs):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "mix_sources", "encode"]
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
    single = corpus_pipeline.STAGES[1][1](spark, docs, SMALL)
    assert kept.columns == single.columns == docs.columns and kept.count() >= docs.count() - 2
    classes = {r.class_id for r in near_duplicates.near_duplicate_classes(docs).collect()}
    assert {r.doc_id for r in single.collect()} == classes
    result = corpus_pipeline.run(spark, SMALL).collect()
    assert all(r.lossless for r in result) and {r.doc_id for r in result} <= classes


@pytest.mark.parametrize(("page", "texts"), [
    ("<head><title>t</title><body><header>h</header><p>x</p>", ["h", "x"]),
    ("İİİİ<script>var a='</p>'</script><p>y</p>", ["İİİİ", "y"]),
    ("<p>a<script src=/x/>no</script>b</p>< 5 z", ["a", "b", "< 5 z"]),
    ("<button>no</BUTTON> a <button>b <p>c", ["a b", "c"]),
    ("<p>k <select><option>1</select> m<svg/>n", ["k", "mn"]),
    ("<p>x<style>no", ["x"]),
])
def test_text_blocks_of_untidy_pages(page, texts):
    assert [t for t in html_text.parse(page).text if t] == texts
