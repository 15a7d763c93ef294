"""Packing, sharding, token files, mixing, quality and sentence spans: exact round trips
and brute force."""

import gc
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import passage, rows, table
from tokenizers import Tokenizer

from teledex.llm import token_store
from teledex.llm.mixing import mix, plan
from teledex.llm.packing import best_fit_decreasing, bins_at_least, complete_bins, pack
from teledex.llm.quality import judge_quality, keep_good
from teledex.llm.queries import QUERIES
from teledex.llm.sentence_spans import remove_repeats, sentences
from teledex.llm.sharding import assign_shards, hilbert_index, write_shards
from teledex.llm.tokens import ChunkEncoder, encoder
from teledex.storage import listed, shared_folder


def ids_of(file, texts, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    return [[*x.ids, end] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def bins_of(plan_):
    return sum(n for _, n in plan_)


@pytest.mark.parametrize("lengths", [[5, 5, 5], [6, 4, 3, 3, 2, 2], [7, 5, 5, 4, 4, 3, 2], [10] * 3 + [1], [6, 6, 5, 5, 4, 4, 3, 3, 2, 2], []])
def test_bin_completion_is_optimal_on_small_bins(lengths):
    def fewest(left, bins):
        if not left:
            return len(bins)
        best, tried = 99, set()
        for i, room in enumerate(bins):
            if room >= left[0] and room not in tried:
                tried.add(room)
                best = min(best, fewest(left[1:], bins[:i] + [room - left[0]] + bins[i + 1 :]))
        return min(best, fewest(left[1:], [*bins, 10 - left[0]]))

    counts = np.bincount(lengths, minlength=11) if lengths else np.zeros(11, int)
    found = complete_bins(counts)
    used = np.zeros(11, int)
    for filling, n in found:
        assert sum(a * k for a, k in filling) <= 10
        for a, k in filling:
            used[a] += n * k
    assert (used == counts).all()
    assert bins_at_least(counts) <= bins_of(found) == fewest(sorted(lengths, reverse=True), []) <= bins_of(best_fit_decreasing(counts))


def check_packing(got, texts):
    want = ids_of("byte_bpe_50k.json", [t for _, t in texts], 0)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for (doc_id, _), ids in zip(texts, want):
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert own[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(own, own[1:]))
        assert own[-1].start + own[-1].length == len(ids) and all(r.length == 2048 for r in own[1:]) and own[0].length <= 2048
        assert all(r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for r in own)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
    return len(sequences), -(-sum(map(len, want)) // 2048)


def test_packing_round_trip(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used, least = check_packing(QUERIES["op1_best_fit_packing"](spark, sf_dir).collect(), texts)
    assert used <= least + 1
    single = [r for i, r in enumerate(rows()) if i < 13]
    check_packing(pack(table(spark, single)).collect(), [(r[0], r[1]) for r in single])
    assert pack(table(spark)).count() >= len(rows()) and pack(table(spark).limit(0)).count() == 0


def test_hilbert_curve_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        path = cells[np.argsort(hilbert_index(cells, bits))]
        assert sorted(hilbert_index(cells, bits)) == list(range(len(cells)))
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_shards(got, given):
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted((d or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in given)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    return slots


def test_shards(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    slots = check_shards(QUERIES["op4_hilbert_sharding"](spark, sf_dir).collect(), given)
    assert sorted(slots) == list(range(24)) and len({len(x) // 2 for x in slots.values()}) <= 2 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    got = assign_shards(docs, shards=4, law="bytes").collect()
    check_shards(got, given)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(4)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got)
    check_shards(assign_shards(table(spark)).collect(), [(r[0], r[1]) for r in rows()])
    assert assign_shards(table(spark).limit(0)).count() == 0
    write_shards(docs, str(tmp_path / "s"), 8, ["source", "lang", "n_chars"])
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 8
    spans = [len({r.source for r in back.filter(f"shard = {s}").select("source").collect()}) for s in range(8)]
    assert sum(spans) < 0.7 * 8 * docs.select("source").distinct().count()  # shards can be skipped


def test_shards_by_text_with_a_shared_start(spark):
    given = [(i, "text", None if i % 17 == 0 else f"https://host{i % 7}.example/", 1) for i in range(800)]
    sources = {i: s for i, _, s, _ in given}
    got = assign_shards(table(spark, given), shards=8, dimensions=("source",)).collect()
    spans = [{sources[r.doc_id] for r in got if r.shard == k} for k in range(8)]
    assert len(got) == 800 and sum(map(len, spans)) <= 8 + 7  # runs of eight values, cut seven times
    order = [sources[r.doc_id] or "" for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def check_store(got, given):
    order = sorted(given, key=lambda x: (x[0] is not None, x[0] or 0))
    ids = ids_of("word_bpe_49k.json", [t for _, t in order], 2)
    starts = np.cumsum([0, *map(len, ids)])
    assert sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in got) == [(int(s), len(x), crc(x), d) for s, x, (d, _) in zip(starts, ids, order)]


def test_token_store_round_trip(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_store(QUERIES["op7_token_store"](spark, sf_dir).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    single = [r for i, r in enumerate(rows()) if i < 13]
    check_store(token_store.stored(table(spark, single)).collect(), [(r[0], r[1]) for r in single])
    check_store(token_store.stored(table(spark, [(None, "a", None, None), *single])).collect(), [(None, "a"), *[(r[0], r[1]) for r in single]])
    assert token_store.stored(table(spark)).count() == len(rows()) and token_store.stored(table(spark).limit(0)).count() == 0


def test_chunks_give_the_ids_of_whole_texts():
    texts = ["A, b. <|ENDOFTEXT|> x<|endoftext|>, Y", "H\u0331 W\u030a, I\u0307.", "a\r\nb\tc,d.)x' it's, It'S.", "", "  ", "ÀÉ, ß. ﬁ, \u212a, Å.", "naïve, can't!! ..., a.b.c. 12,3", "\x01 a\x01, b", "Straße, œuvre; x" * 300]
    for file in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        known = encoder(file)
        want = [x.ids for x in known.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        for _ in range(2):  # the second time chunks are remembered
            ids, counts = known.encode(pa.array([*texts, None]))
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [*want, []]


def test_remembered_chunks_take_little_memory():
    texts = [" ".join(f"{i * 2654435761 % (1 << 32):x}{j}" for j in range(10)) for i in range(4_000)]
    for file in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        known = ChunkEncoder(file)
        want = [x.ids for x in known.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        known.encode(pa.array(["", "a b"]))
        gc.collect()
        arrow = pa.total_allocated_bytes()
        tracemalloc.start()
        ids, counts = known.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        del ids, counts
        gc.collect()
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
        tracemalloc.stop()
        assert len(known.known) > 30_000 and held < 100 * len(known.known)  # 142 a chunk as Python strings


def test_segments_decode_from_any_block_and_notice_damage():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 70_000), 49_407).astype(np.uint32)
    freq = token_store.scaled(np.bincount(ids))
    assert freq.sum() == 1 << token_store.SCALE_BITS and (freq[np.unique(ids)] > 0).all()
    for part in (ids, ids[:1], ids[: token_store.BLOCK], ids[:33]):
        assert (token_store.decode_segment(token_store.encode_segment(part, freq), freq) == part).all()
    data = token_store.encode_segment(ids, freq)
    block = token_store.BLOCK
    assert (token_store.decode_segment(data, freq, 2, 4) == ids[2 * block : 4 * block]).all()
    p = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert len(data) * 8 < len(ids) * (-(p * np.log2(p)).sum() + 0.3)
    bad = bytearray(data)
    bad[-5] ^= 1
    with pytest.raises(ValueError):
        token_store.decode_segment(bytes(bad), freq)


def test_mixing_meets_its_targets(spark):
    given = [(i, passage(i % 50, 5 + i % 9), "big" if i % 10 else f"small{i % 3}", i) for i in range(900)]
    df = table(spark, given)
    drawn = mix(df, repetition=2.0, draws=True).collect()
    times = defaultdict(int)
    for r in drawn:
        times[r.doc_id] += 1
    assert set(times) == {g[0] for g in given} and max(times.values()) <= 2
    tokens = defaultdict(int)
    for r in drawn:
        tokens[r.source] += r.tokens
    own = defaultdict(int)
    for g in given:
        own["=" + g[2]] += len(g[1].split())
    rates = {s: tokens[s] / own[s] for s in own}
    assert rates["=big"] == 1 and 1.9 < max(rates.values()) <= 2
    for s in own:  # the same exponent for all
        a = 1 - np.log(2) / np.log(max(own.values()) / min(own.values()))
        assert abs(rates[s] - (own[s] / own["=big"]) ** (a - 1)) < 0.15
    assert mix(df, repetition=2.0).columns == df.columns
    assert sorted(r.doc_id for r in mix(df).collect()) == sorted(r.doc_id for r in drawn)
    shares = spark.createDataFrame([("a", 900, 0.9), ("b", 90, 0.09), ("c", 10, 0.01)], "`group` string, tokens bigint, share double")
    weights = [r.weight for r in plan(shares, entropy=0.9).collect()]
    assert abs(sum(weights) - 1) < 1e-9 and abs(-sum(w * np.log(w) for w in weights) - 0.9) < 1e-3
    assert mix(table(spark)).count() >= len(rows()) and mix(df.limit(0)).count() == 0


def test_mixing_draws_rows_as_often_as_it_lists_them(spark):
    """Equal rows, rows that two sources share, and rows without id or text."""
    given = [(i, passage(i % 50, 5 + i % 9), "big", i) for i in range(400)]
    given += [(i, passage(i % 50, 5 + i % 9), "small", -i) for i in range(20)]
    given += [(1000, passage(7), "mid", i) for i in range(40)] + [(None, None, "tiny", i) for i in range(9)] + [(None, None, None, 1)] * 3
    df = table(spark, given)
    for repetition in (2.0, 3.3):
        want, got = defaultdict(int), defaultdict(int)
        for r in mix(df, repetition=repetition, draws=True).collect():
            want[r.doc_id, r.source] += 1
        rows_drawn = mix(df, repetition=repetition).collect()
        for r in rows_drawn:
            got[r.doc_id, "null" if r.source is None else "=" + r.source] += 1
        assert got == want
        assert {r.score for r in rows_drawn if r.source == "mid"} == set(range(40))  # each of the equal rows comes
        passes = defaultdict(set)
        for r in rows_drawn:
            passes[r.doc_id, r.source, r.score].add(r.text)
        assert len(passes) == len(given) - 2  # two rows are the same in all columns


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op9_quality"](spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [got[i].predicted == q for i, q in labels if got[i].held_out]
    assert np.mean(held) > 0.95
    flipped = spark.createDataFrame([(i, 1 - q if got[i].held_out else q) for i, q in labels], "doc_id bigint, quality int")
    again = judge_quality(spark.read.parquet(f"{sf}/documents.parquet"), flipped).collect()
    assert all(abs(r.score - got[r.doc_id].score) < 1e-9 for r in again)  # held-out labels aren't read
    hard = table(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(13)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    assert judge_quality(hard, labels).count() == len(rows()) and keep_good(hard, labels).columns == hard.columns
    assert judge_quality(hard, labels.limit(0)).count() == len(rows()) and judge_quality(hard.limit(0), labels).count() == 0


def test_sentence_spans_equal_brute_force(spark, sf_dir):
    assert "".join(sentences("A b. C d!  E\n\nf g? h.i")) == "A b. C d!  E\n\nf g? h.i" and len(sentences("A b. C d!  E\n\nf g? h.i")) == 5
    given = [(r.doc_id, r.text, "s", 1) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    given += [(1000, " ".join(f"This is {w}." for w in "abcdef"), "s", 1), (1001, "New. " + " ".join(f"This is {w}." for w in "bcdef") + " Old.", None, None)]
    for own in (given, [r for i, r in enumerate(rows()) if i < 13]):
        seen, marks = {}, defaultdict(set)
        for d, t, *_ in sorted(own, key=lambda r: r[0]):
            parts = [" ".join(x.split()) for x in sentences(t)]
            for i in range(len(parts) - 2):
                if seen.setdefault(tuple(parts[i : i + 3]), (d, i)) != (d, i):
                    marks[d] |= {i, i + 1, i + 2}
        want = {d: t if not marks[d] else "".join(x for i, x in enumerate(sentences(t)) if i not in marks[d]) for d, t, *_ in own}
        got = remove_repeats(table(spark, own))
        assert got.columns == table(spark, own).columns
        assert {r.doc_id: r.text for r in got.collect()} == want
    assert want and remove_repeats(table(spark)).count() == len(rows()) and remove_repeats(table(spark).limit(0)).count() == 0
    assert re.search("Old", {r.doc_id: r.text for r in remove_repeats(table(spark, given)).collect()}[1001])


def test_repeated_passages_in_other_text(spark):
    rng = random.Random(11)

    def prose(n, mean=12):
        out = [f"{rng.choice('bcdfgk')}{rng.randrange(10**6)}" for _ in range(n)]
        for i in range(0, n, mean):
            out[i] += rng.choice([".", ",", "", "!"])
        return " ".join(out)

    # More than 50 words in one, two and three sentences, and without any mark, spliced
    # into the middle of sentences; also a script without spaces.
    plain = [f"p{i}x{i * i % 37}" for i in range(120)]
    passages = [" ".join(plain[:51]), " ".join(plain[:60]) + ".", "So " + " ".join(plain[60:86]) + ". And " + " ".join(plain[86:115]) + ".", "A " + " ".join(plain[5:25]) + ". B " + " ".join(plain[30:50]) + "! C " + " ".join(plain[70:90]) + "?"]
    passages += [prose(51, 70) for _ in range(20)] + ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))]
    given, early = [], len(passages)
    for i in range(2 * early):
        given.append((i, prose(rng.randint(5, 40)) + " " + passages[i % early] + " " + prose(rng.randint(5, 40)), "s", 1))
    short = [(900, "Only one sentence", "s", 1), (901, "Only  one sentence", "s", 1), (902, "Another text.", "s", 1), (903, "", "s", 1), (904, None, "s", 1)]
    for words, share in ((50, 1.0), (None, 0.2)):
        got = {r.doc_id: r for r in remove_repeats(table(spark, given + short), counts=True, words=words).collect()}
        cut = [i for i in range(early, 2 * early) if got[i].text != given[i][1] and got[i].n_removed > 0]
        assert len(cut) == early if share == 1.0 else len(cut) <= share * early
        assert words is None or got[901].text == ""
        assert [got[i].text for i in (900, 902, 903, 904)] == ["Only one sentence", "Another text.", "", None]
    got = {r.doc_id: r.text for r in remove_repeats(table(spark, given), words=50).collect()}
    for i, text, *_ in given:
        head, _, tail = text.partition(passages[i % early])
        if i >= early and i % early > 3:
            assert got[i].startswith(head) and got[i].endswith(tail)  # nothing of its own goes
            assert len(got[i].split()) < len(text.split()) - (20 if i % early < early - 1 else -1)
    # Passages 0 to 3 share words with each other; all first occurrences of the others stay.
    assert all(got[i] == given[i][1] for i in range(4, early)) and got[0] == given[0][1]


def test_sentence_spans_leave_no_places_behind(spark):
    """What a run wrote on the way is gone before the texts are cut."""
    docs = table(spark, [(i, passage(i % 3, 90), "s0", 1) for i in range(9)])
    before = set(listed(spark, shared_folder(spark)))
    cut = remove_repeats(docs, words=50)
    left = {x.rsplit("-", 1)[0] for x in set(listed(spark, shared_folder(spark))) - before}
    assert left == {"span-marks"}
    assert [r.text == passage(r.doc_id % 3, 90) for r in cut.orderBy("doc_id").collect()] == [True] * 3 + [False] * 6
