"""The operators' methods: fuzzed against plain versions, with blocks, buckets and groups small enough to be split."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from etalage.llm import contamination, line_dedup, packing, quality, sharding, simhash, suffix_dedup, token_counts, url_filters, warc
from etalage.llm.components import components

ALPHABETS = ["ab", "abc \n", "aé🙂\u0085 ß'’sStT019٣²½ \n\t\x1c_.,!", "".join(map(chr, range(1, 0x250)))]


def texts(seed, n=200, size=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randint(0, size))) for _ in range(n)]


# token counts -----------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(4))
def test_merging_gives_the_tokenizer_s_counts(seed):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, own = Tokenizer.from_file(path), token_counts.Counter(path)
    some = texts(seed, 300) + ["<|endoftext|>", "a<|endoftext|> b", "<|endoftext", "x" * 3000, "ab" * 2000, " " * 999, "the " * 500]
    assert own.counts([t.encode() for t in some]) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in some]


def test_every_character_is_cut_like_the_tokenizer_does():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, own = Tokenizer.from_file(path), token_counts.Counter(path)
    some = [f"a{chr(c)}b1{chr(c)} {chr(c)}{chr(c)}." for c in range(1, 0x3400) if not 0xD800 <= c < 0xE000]
    assert own.counts([t.encode() for t in some]) == [len(e.ids) for e in tokenizer.encode_batch(some, add_special_tokens=False)]


def test_pairs_of_equal_symbols_merge_from_the_left():
    flags = np.array([1, 1, 1, 0, 1, 1, 0, 1], bool)
    assert token_counts._every_other(flags).tolist() == [0, 2, 4, 7]


# packing ----------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_words_are_encoded_like_whole_texts(seed):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, own = Tokenizer.from_file(path), packing.Encoder(path)
    some = texts(seed) + ["a<|endoftext|>b <|startoftext|>", "ΑΣ ΟΔΟΣ", "é e ́", "İi", "x" * 500, " a "]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
    assert own.batch([t.encode() for t in some]) == want


@pytest.mark.parametrize("seed", range(4))
def test_assignment_fills_sequences_and_balances_cost(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(np.concatenate([rng.integers(1, 4097, 300), rng.integers(1, 200, 1500), [4096] * 20]))[::-1]
    sequence, offset = packing.assign(lengths, 4096)
    used = np.bincount(sequence, weights=lengths)
    assert used.max() <= 4096 and len(used) <= 1.02 * lengths.sum() / 4096 + 2
    for s in range(len(used)):
        at = np.argsort(offset[sequence == s])
        assert (np.cumsum(lengths[sequence == s][at]) - lengths[sequence == s][at] == offset[sequence == s][at]).all()


def test_pieces_of_many_groups(spark, docs):
    rows = [(i % 3, "word " * (i % 50)) for i in range(300)]
    out = packing.pack(docs(rows), group_pieces=40, capacity=64)
    got = [tuple(r) for r in out.collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert brute.check_packing(rows, got, tokenizer, 64) < 0.2


# decontamination --------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("block_words", [4, 30, 1000])
def test_items_in_blocks(spark, block_words):
    rng = random.Random(block_words)
    words = [rng.choice("abcde") for _ in range(4000)]
    documents = [(i, " ".join(words[i * 40:i * 40 + rng.randint(0, 60)]).upper() + "!") for i in range(60)]
    items = [(i, " ".join(words[rng.randrange(3000):][:rng.choice([1, 3, 5, 8, 20])])) for i in range(25)] + [(3, None), (4, "a b c d e")]
    df = spark.createDataFrame(documents, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out, name = contamination.matched(df, bench, window=5, block_words=block_words)
    m = F.col(name)
    got = sorted(tuple(r) for r in out.select("doc_id", m["n_words"], contamination.n_hit(m), F.size(m["items"]),
                                              F.sha2(F.array_join(m["items"], ","), 256), contamination.contaminated(m)).collect())
    assert got == sorted(brute.contamination(documents, items, 5))


def test_spans_are_cut_and_documents_dropped(spark):
    item = " ".join(f"w{i}" for i in range(13))
    df = spark.createDataFrame([(1, f"Before, {item.upper()}; after."), (2, "clean"), (3, None),
                                (4, item + " x" * 400)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in contamination.cut_spans(df, bench).collect()}
    assert cut == {1: "Before, ; after.", 2: "clean", 3: None, 4: " x" * 400}
    assert sorted(r["doc_id"] for r in contamination.drop_contaminated(df, bench).collect()) == [2, 3, 4]


# lines ------------------------------------------------------------------------------------------------------------------

def test_common_lines_go_and_texts_stay_in_order(spark, docs):
    rows = [(i, f"  Common LINE\t\nown {i}\n\ncommon line") for i in range(12)] + [(99, None), (98, ""), (0, "  Common LINE\t\nown 0\n\ncommon line")]
    out = line_dedup.drop_common_lines(docs(rows))
    assert out.columns == docs(rows).columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(
        [(i, f"own {i}\n") for i in range(12)] + [(99, None), (98, ""), (0, "own 0\n")], key=str)
    few = line_dedup.drop_common_lines(docs(rows), min_chars=12)
    assert few.where("text like '%ommon%'").count() == 13


# SimHash ----------------------------------------------------------------------------------------------------------------

def prints(spark, fps):
    return spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")


@pytest.mark.parametrize("parts,bucket_rows", [(4, 4096), (4, 20), (4, 200), (5, 8)])
def test_links_connect_what_is_near(spark, parts, bucket_rows):
    rng = random.Random(parts * bucket_rows)
    fps = {rng.getrandbits(64) for _ in range(200)}
    centre = rng.getrandbits(64)
    for _ in range(250):  # near copies of one text, most of them within three bits of others
        centre2 = centre
        for b in rng.sample(range(64), rng.randint(0, 4)):
            centre2 ^= 1 << b
        fps.add(centre2)
    fps = sorted(fps)
    frame = prints(spark, fps)
    found = components(simhash.links(frame, parts=parts, bucket_rows=bucket_rows), "a", "b").collect()
    root = {r["node"]: r["root"] for r in found}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    got, want = {}, {}
    for f, g in zip(signed, brute.groups_of(fps)):
        got.setdefault(root.get(f, f), set()).add(f)
        want.setdefault(g, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_thresholds_sum_to_what_the_principle_needs():
    rng = np.random.default_rng(1)
    groups = [list(range(i, 64, 4)) for i in range(4)]
    near = [np.cumsum(rng.integers(0, 1000, (4, 1 << 16)), axis=0) for _ in groups]
    t = simhash.allocate(rng.integers(-2**62, 2**62, 50), groups, near)
    assert (t.sum(axis=1) == simhash.TAU - len(groups) + 1).all() and t.min() >= -1


def test_one_of_each_group_stays(spark, docs):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, base), (3, base + " more"), (3, base + " more"), (None, base), (9, "quite another text of some words"), (8, None), (7, "")]
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one_each(docs(rows)).collect()), key=str)
    assert kept == sorted([(3, base + " more"), (9, "quite another text of some words"), (7, "")], key=str)


# components -------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    links = {"chain": [(i, i + 1) for i in range(80)], "star": [(1000, i) for i in range(80)] + [(5, 5), (None, 3)],
             "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(170)], "none": [(1, 1)]}[shape]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert {r["node"]: r["root"] for r in found} == {x: find(x) for x in list(parent)} and len(found) == len(parent)


# URLs -------------------------------------------------------------------------------------------------------------------

def test_blocks_reach_aliases_and_explicit_allows_come_first(spark):
    link = '<link href="{0}" rel="canonical">'
    pages = spark.createDataFrame([
        (1, "http://a.net/x", link.format("http://b.example.com/en/1")),         # alias of a blocked address
        (2, "http://c.net/y#top", '<META http-equiv=refresh content="0; URL=/x2">'),
        (3, "http://c.net/x2", link.format("https://a.net/x")),                   # a chain of aliases
        (4, "http://www.example.com/en/1", link.format("http://d.net/z")),        # explicitly allowed
        (5, "http://d.net/z", link.format("http://q.net/es/1")),                  # allowed alias beats the blocked one
        (6, "http://e.net/", "<link rel=stylesheet href=x.css>"), (7, None, None), (8, "http://b.example.com/en/1", "")],
        "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://f.net/1", "http://a.net/x")], "source string, target string")
    out, name = url_filters.judge(pages, redirects=redirects)
    assert {r["page_id"]: r[name]["verdict"] for r in out.collect()} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block"}


def test_links_are_resolved_as_browsers_do(spark):
    page = "http://h.net/a/b/p.html?k=1"
    links = {"?q=2&amp;r": "h.net/a/b/p.html?q=2&r", "./x": "h.net/a/b/x", "../x/": "h.net/a/x/", "../../../y/..": "h.net/",
             "/go?u=http://example.com/en/": "h.net/go?u=http://example.com/en/", "https://o.org/a/../b?x=1&amp;y#f": "o.org/b?x=1&y",
             "//o.org": "o.org", "mailto:a@b.net": None, "#f": None, "&#x2f;k": "h.net/k"}
    rows = [(i, page, f"<link rel=canonical href='{x}'>") for i, x in enumerate(links)]
    got = url_filters.page_links(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r["target"] for r in got) == sorted(x for x in links.values() if x)
    pages = [(1, page, "<link rel=canonical href='/go?u=http://example.com/en/'>"), (2, "http://c.org/x", "<link rel=canonical href='/en/?a=1&amp;b=2'>"),
             (3, "http://c.org/en/?a=1&b=2", "<link rel=canonical href='http://example.com/en/../en/z'>")]
    out, name = url_filters.judge(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r["page_id"]: r[name]["verdict"] for r in out.collect()} == {1: "allow", 2: "block", 3: "block"}


# sharding ---------------------------------------------------------------------------------------------------------------

def test_shards_of_repeated_rows(spark, docs):
    rows = [(1, "same")] * 400 + [(None, "n" * 9)] * 100 + [(i, "x" * (i % 40)) for i in range(300)]
    placed = sharding.shard_documents(docs(rows))
    got = [(r["doc_id"], r["size"], r["text_crc32"], "bytes", r["shard"], r["slot"], None) for r in placed.collect()]
    assert brute.check_shards(rows, got) <= 45


def test_shards_are_written(spark, docs, tmp_path):
    rows = [(i, f"text {i} " * (i % 20)) for i in range(200)]
    sharding.write_shards(docs(rows), str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == rows


# archives ---------------------------------------------------------------------------------------------------------------

def test_bundles_can_be_read_by_any_decompressor_and_by_frame(tmp_path):
    writer = warc.BundleWriter(str(tmp_path), frame_bytes=300)
    data = [warc.record(i, i, f"http://x/{i} ü", (b"payload %d " % i) * i, "D", 9) for i in range(20)]
    places = [writer.add(d) for d in data]
    writer.close()
    raw = open(writer.uri, "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole == b"".join(data)
    reader = warc.BundleReader(writer.uri)
    for i, (frame, at) in enumerate(places):
        fields, block, _ = warc.parse(reader.frame(frame), at)
        assert fields["X-Page-Id"] == str(i) and block.endswith((b"payload %d " % i) * i)
    assert len({f for f, _ in places}) > 3


def test_small_bundles_and_small_payloads(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "p" * (i % 5)) for i in range(50)], "page_id long, url string, html string")
    index = warc.write_bundles(pages, min_bytes=3, frame_bytes=500, bundle_bytes=4000)
    assert index.select("bundle").distinct().count() > 1
    got = sorted((int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] and int(r["refers_to"]))
                 for r in warc.read_bundles(index).collect())
    assert got == sorted(brute.archive([(i, "p" * (i % 5)) for i in range(50)], 3))


# repeated strings -------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("length,group_rows", [(1, 1024), (2, 1024), (5, 1024), (12, 1024), (12, 2), (40, 1024), (40, 1), (40, 3)])
def test_repeated_strings(spark, length, group_rows):
    rng = random.Random(length * 1000 + group_rows)
    passage = "".join(rng.choice("abcdefgh é") for _ in range(3 * length))
    rows = [(None, passage), (None, None), (2, ""), (3, "aaaa" * length), (3, "aaaa" * length)]
    for i in range(40):
        own = "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 2 * length)))
        cut = rng.randint(0, len(passage))
        rows.append((i, own + passage[:cut] + rng.choice("xyz") + passage[cut // 2:] + own[::-1]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out, spans = suffix_dedup.with_repeats(df, length=length, group_rows=group_rows)
    got = [tuple(r["d"]) for r in out.select(suffix_dedup._digests(length)(F.col("text"), F.col(spans)).alias("d")).collect()]
    assert sorted(got) == sorted(r[1:] for r in brute.suffixes(rows, length))


def test_groups_of_one_task_are_bounded(spark, monkeypatch):
    """A passage of many documents, longer than the strings, makes many entries of one kind."""
    rng, length, group_rows = random.Random(8), 40, 8
    passage = "".join(rng.choice("abcdefgh") for _ in range(50))
    rows = [(i, *("".join(rng.choice("ijklmnop") for _ in range(60)) for _ in range(2))) for i in range(90)]
    rows = [(i, a + (passage if i % 3 else passage[:44]) + b) for i, a, b in rows]
    solved, sizes = suffix_dedup._solved_groups, []

    def counted(entries, length):
        sizes.append(max((r["count"] for r in entries.groupBy("name").count().collect()), default=0))
        return solved(entries, length)

    monkeypatch.setattr(suffix_dedup, "_solved_groups", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out, spans = suffix_dedup.with_repeats(df, length=length, group_rows=group_rows)
    got = [tuple(r["d"]) for r in out.select(suffix_dedup._digests(length)(F.col("text"), F.col(spans)).alias("d")).collect()]
    assert sorted(got) == sorted(r[1:] for r in brute.suffixes(rows, length))
    assert len(sizes) > 1 and max(sizes) <= group_rows


@pytest.mark.parametrize("w,k", [(1, 1), (4, 3), (7, 2), (25, 15)])
def test_anchors_are_the_least_of_some_window(w, k, monkeypatch):
    rng = random.Random(w)
    text = bytes(rng.choice(b"abc") for _ in range(400)) + b"a" * 100
    whole = suffix_dedup.anchors(text, w, k).tolist()
    assert all(any(p <= a < p + w for a in whole) for p in range(len(text) - k - w + 2))
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 37)
    assert suffix_dedup.anchors(text, w, k).tolist() == whole


# quality ----------------------------------------------------------------------------------------------------------------

def test_thresholds_follow_the_group_and_merge_for_small_ones(spark):
    rng = random.Random(2)

    def text(width, symbols=0):
        return "\n".join(" ".join("".join(rng.choice("abcdefghijkl") for _ in range(width + rng.randint(-1, 1))) + "#" * symbols
                                  for _ in range(20)) for _ in range(5))

    rows = [(i, text(5), "en", "a") for i in range(300)] + [(1000 + i, text(11), "de", "b") for i in range(300)]
    rows += [(2000, text(11), "en", "a"), (2001, text(11), "de", "b"), (2002, text(5, 1), "en", "a"), (2003, text(5), "en", "rare"),
             (2004, text(11), "en", "rare"), (2005, text(5), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out, name = quality.judged(df, min_docs=50)
    kept = {r["doc_id"]: r[name]["kept"] for r in out.collect()}
    assert [kept[i] for i in range(2000, 2005)] == [False, True, False, True, False]
    assert sum(kept[i] for i in range(300)) == 300 and sum(kept[i] for i in range(1000, 1300)) == 300


def _plain(rng, width, symbols=0):
    """100 words; a symbol after every other word, or several."""
    return "\n".join(" ".join("".join(rng.choice("abcdefghijkl") for _ in range(width)) + "#" * (symbols if i % 2 else 0)
                              for i in range(20)) for _ in range(5))


def test_one_document_more_does_not_switch_the_limits(spark):
    rng = random.Random(4)
    rows = [(i, _plain(rng, 5), "en", "most") for i in range(400)]
    rows += [(1000 + i, _plain(rng, 9), "en", "below") for i in range(49)] + [(2000 + i, _plain(rng, 9), "en", "at") for i in range(50)]
    out, name = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), min_docs=50)
    assert all(r[name]["kept"] for r in out.collect())
