"""The parts of the operators that run inside tasks, against brute force."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from tidewell.llm import bpe, gru, lm, lsh, main_text, packing, quality, sharding, simhash, vantage
from tidewell.llm.boosting import boosted, threshold
from tidewell.llm.common import lower_words
from tidewell.llm.mincut import source_side

PIECES = ["a", "b", "É", "é", " ", "  ", "\n", "\t", ".", "!", "'s", "<|endoftext|>", "1", "22", "\x1c", "\xa0", "日本"]
PIECES += ["ing", " the", "Σ", "İ", "ß", "\U0001f600", "</w>", "_", " "]


def texts(n, length=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(length))) for _ in range(n)] + ["", " ", "x" * 3000]


def test_fingerprints():
    for text in texts(300):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        expected = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == expected


@pytest.mark.parametrize("depth", [0, 2, 5])
def test_vantage_points_lose_no_pair(depth):
    rng = np.random.default_rng(depth)
    base = rng.integers(0, 2**63, 400, dtype=np.int64).view(np.uint64)
    near = [base]
    for _ in range(4):
        copy = base[:200].copy()
        for _ in range(5):
            copy ^= np.uint64(1) << rng.integers(0, 64, len(copy)).astype(np.uint64)
        near.append(copy)
    points = np.unique(np.concatenate(near))
    i, j = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 4)
    expected = vantage.Groups(len(points))
    expected.join(i, j)
    tree = vantage.Tree.fit(points, depth, 4, 1.0, 1 << 17)
    at, leaf, home = tree.route(points)
    groups = vantage.Groups(len(points))
    for number in np.unique(leaf):
        here, own = at[leaf == number], home[leaf == number]
        search = vantage.Search(points[here], 4)
        search.within(np.nonzero(own)[0])
        search.between(np.nonzero(own)[0], np.nonzero(~own)[0])
        groups.join(here, here[search.groups.roots(np.arange(len(here)))])
    every = np.arange(len(points))
    assert np.array_equal(groups.roots(every), expected.roots(every))


@pytest.mark.parametrize(("count", "bound"), [(10**5, 6), (10**6, 10), (15 * 10**6, 30)])
def test_a_random_fingerprint_is_sent_a_bounded_number_of_times(count, bound):
    rng = np.random.default_rng(1)
    depth = math.ceil(math.log2(count / max(2048, int(32 * math.sqrt(count)))))
    sample = np.sort(rng.integers(0, 2**64, simhash.TREE_SAMPLE, dtype=np.uint64))
    tree = vantage.Tree.fit(sample, depth, 4, count / len(sample), simhash.LEAF_BLOCK)
    points = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    _, leaf, home = tree.route(points)
    assert home.sum() == len(points)
    assert tree.blocks[leaf].sum() < bound * len(points)


def test_quality_statistics():
    for text in texts(800, 60):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        again = set()
        for i in range(len(words) - 7):
            if windows[tuple(words[i : i + 8])] > 1:
                again.update(range(i, i + 8))
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        expected = (
            len(words),
            sum(map(len, words)),
            len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)),
            len(again),
        )
        assert quality.statistics(text)[:5] == expected


def test_forest_finds_outliers_and_threshold_spares_good_rows():
    rng = np.random.default_rng(0)
    good, bad = rng.uniform(-1, 1, (900, 5)), rng.uniform(-1, 1, (100, 5)) + [8, 0, 0, 8, 0]
    rows, marks = np.concatenate([good, bad]), np.arange(1000) < 900
    scores = quality.Forest(rows).score(rows)
    limit = quality.threshold(scores, marks)
    assert (scores[~marks] > limit).mean() > 0.9
    assert (scores[marks] > limit).mean() <= quality.GOOD_LOST
    assert quality.threshold(scores, np.ones(1000, bool)) == float("inf")


def test_word_bpe_equals_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    codec, tokenizer = bpe.Codec(path), Tokenizer.from_file(path)
    rng = random.Random(2)
    some = texts(2000) + ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 20))) for _ in range(3000)]
    for text, expected in zip(some, tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids
        assert codec.decode(ids).decode() == tokenizer.decode(expected.ids, skip_special_tokens=False)


def test_byte_bpe_by_words_equals_the_tokenizer():
    path, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    tokenizer, some = Tokenizer.from_file(path), texts(2000)
    expected = [x.ids for x in tokenizer.encode_batch(some, add_special_tokens=False)]
    for encoder in (packing.WordTokens(path), packing.WordTokens(path, ranks)):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(some)] == expected


def least_cost(at, penalty, width):
    where, best = [0, *at], [0.0] + [float("inf")] * len(at)
    for j in range(1, len(where)):
        for i in range(j):
            length = where[j] - where[i]
            if length <= width:
                full = length & (length - 1) == 0 and (length * 16 >= width or where[j] >= where[-1] - 2 * width)
                cost = 0 if full else width - length
                best[j] = min(best[j], best[i] + cost + penalty[j - 1] + packing.SEQUENCE_COST)
    return best[-1]


def test_cuts_are_optimal():
    rng = random.Random(3)
    for _ in range(300):
        at = np.cumsum([rng.randrange(1, 17) for _ in range(rng.randrange(1, 50))])
        penalty = np.array([rng.choice([0, 2.0, 12.0]) for _ in at])
        cuts, cost, start = packing.best_cuts(at, penalty, 32), 0.0, 0
        of = dict(zip(at.tolist(), penalty.tolist(), strict=True))
        for cut in cuts.tolist():
            length = cut - start
            assert 0 < length <= 32
            cost += (0 if length & (length - 1) == 0 else 32 - length) + of[cut] + packing.SEQUENCE_COST
            start = cut
        assert start == at[-1] and cost <= least_cost(at.tolist(), penalty, 32) + 1e-9


def test_pieces_cover_every_token_once():
    encoder = packing.WordTokens(public_tokenizers.path("byte_bpe_50k.json"))
    some = texts(200) + ["One sentence. And another one! " * 400, "word " * 3000, "", ""]
    doc, start, length, sequence, offset, ids, tokens = packing.packed(some, encoder)
    for number in range(len(some)):
        mine = doc == number
        assert start[mine].tolist() == np.append(0, np.cumsum(length[mine])[:-1]).tolist()
        assert length[mine].sum() == tokens[number]
    sizes = np.bincount(sequence, weights=length).astype(int)
    assert sizes.max() <= packing.WIDTH
    for number in range(len(sizes)):
        mine = sequence == number
        assert offset[mine].tolist() == np.append(0, np.cumsum(length[mine])[:-1]).tolist()
    assert all(len(x) == 4 * n for x, n in zip(ids, length, strict=True))
    padding = sum(packing.WIDTH - n for n in sizes if n & (n - 1))
    assert padding < 0.05 * sizes.sum()


def test_minimum_cut():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(1, 9)
        terminal = [round(rng.uniform(-4, 4), 2) for _ in range(n)]
        edges = [(i - 1, i, rng.choice([0.5, 1, 2])) for i in range(1, n)]
        edges += [(a, b, 0.7) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(3)) if a != b]

        def cost(side, terminal=terminal, edges=edges):
            cut = sum(max(0, -t) if s else max(0, t) for s, t in zip(side, terminal, strict=True))
            return cut + sum(c for a, b, c in edges if side[a] != side[b])

        best = min(cost([mask >> i & 1 for i in range(n)]) for mask in range(1 << n))
        assert abs(cost(source_side(terminal, edges)) - best) < 1e-6


def test_main_text_of_pages():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>"
        "<header><h1>Site</h1></header><div class='cookie-notice'>We use cookies, as you know.</div>"
        "<article><h1>A &amp; B</h1><p>First <b>long</b>\n paragraph, with words.<p>Second one.<br>Here.</p>"
        "<aside>Elsewhere, long text that is not the article.</aside></article>"
        "<section id=comments><article><p>A reader's comment, also long.</p></article></section>"
        "<form><p>Send us your name.</p></form><script>var x='<p>no</p>'</script><footer>&copy; us</footer>"
    )
    expected = "A & B\nFirst long paragraph, with words.\nSecond one. Here."
    assert main_text.main_text(page, main_text.START) == expected
    for broken in ("", "<", "<p", "<!--", "<p>" * 2000, "</div>" * 50, "<script>", "<a href='", "&#0;&bogus;"):
        main_text.main_text(broken, main_text.START)
    plain = "<body><div><p>" + "A sentence with many words, and some more. " * 5 + "</p></div><p><a>x</a></p>"
    assert main_text.main_text(plain, main_text.START).startswith("A sentence")


@pytest.mark.parametrize(
    "page",
    [
        "<article class='post comments-open'><h1>Title</h1><p>{}</p><p>{}</p></article>",
        "<div class='content with-sidebar'><h1>Title</h1><p>{}</p><p>{}</p></div>",
        "<svg viewBox='0 0 1 1'/><iframe src='x>y' /><article><h1>Title</h1><p>{}</p><p>{}</p></article>",
        "<article><h1>Title</h1><p>{}</p><form><p>Send us your name, please, and your address.</p></form><p>{}</p></article>",
        "<article><h1>Title</h1><p>{}</p><div class=ad><p>Buy it now, it is cheap. Really.</p></div><p>{}</p></article>",
        "<form id=f><div><article><h1>Title</h1><p>{}</p><p>{}</p></article></div><p>Not this one, sir.</p></form>",
        "<main><h1>Title</h1><p>{}</p><p>{}</p></main><ol class='comment-list'>" + "<li><p>I read this, too. It is good.</p>" * 40 + "</ol>",
        "<main><h1>Title</h1><p>{}</p><p>{}</p></main><article class=comment><p>I read this, too. It is good.</p></article>",
    ],
)
def test_names_are_signs_and_do_not_decide_alone(page):
    first, second = ("A sentence with many words, and some more. " * 3).strip(), "Short."
    nav = "<nav><ul>" + "<li><a href=x>Menu</a>" * 5 + "</ul></nav>"
    found = main_text.main_text(f"<body class=no-sidebar>{nav}{page.format(first, second)}<footer>End</footer>", main_text.START)
    assert found == f"Title\n{first}\n{second}"


def test_the_cut_takes_weak_blocks_along():
    weak = "<p>{}</p><p><a href=x>see</a></p><p>{}</p>".replace("{}", "A sentence with many words, and some more. " * 3)
    blocks = main_text.blocks_of(f"<article class='entry has-comments'>{weak}</article>")
    logit = main_text.features(blocks[1]) @ main_text.START
    assert max(-main_text.LIMIT, logit) + main_text.surroundings(blocks[1].element) < 0  # alone it would be left out
    assert main_text.labelled(blocks, main_text.START) == [True] * 3


def test_recurrent_model_gradients_and_windows():
    rng = np.random.default_rng(0)
    model = gru.Model(rng.integers(1, 50, (4, 4)))
    for name in model.NAMES:
        setattr(model, name, getattr(model, name) + 0.3 * rng.standard_normal(getattr(model, name).shape))
    some = [rng.integers(0, 16, n) for n in (7, 5, 3, 9)]
    slopes = {}

    def step(name, slope, rows=slice(None)):
        slopes[name] = np.zeros_like(getattr(model, name))
        slopes[name][rows] += slope

    model._step, model.squares = step, {}
    model.train(some, 0, 3, 50)
    loss = lambda: -model.score(some, 0, 3, 50).sum() / 24
    for name in model.NAMES:
        values = getattr(model, name)
        for _ in range(3):
            place = tuple(rng.integers(0, n) for n in values.shape)
            old = values[place]
            values[place] = old + 1e-4
            above = loss()
            values[place] = old - 1e-4
            below = loss()
            values[place] = old
            assert abs((above - below) / 2e-4 - slopes[name][place]) < 2e-3 * max(1e-2, abs(slopes[name][place]))
    # However texts are dealt to streams and cut into windows, the likelihood is that of the whole text.
    assert np.allclose(model.score(some, 0, 4, 50), model.score(some, 0, 2, 2))
    # Chances of all items add up to one.
    state = rng.standard_normal((1, gru.HIDDEN))
    chances = np.exp([model.log_chances(state, np.array([item]))[0] for item in range(16)])
    assert abs(chances.sum() - 1) < 1e-6


def test_probes_come_in_descending_chance_and_hold_their_share():
    rng = np.random.default_rng(5)
    chance = rng.dirichlet(np.ones(19), 3)
    found = lsh.best_first(chance, 0.9)
    cells = [np.frombuffer(x, np.int8) + lsh.FARTHEST for x in found]
    values = [np.prod([chance[i, c] for i, c in enumerate(cell)]) for cell in cells]
    assert len(set(found)) == len(found) and sum(values) >= 0.9
    assert all(a >= b - 1e-12 for a, b in zip(values, values[1:], strict=False))
    every = np.sort((chance[0][:, None, None] * chance[1][None, :, None] * chance[2][None, None, :]).ravel())[::-1]
    assert np.allclose(values, every[: len(values)])


def test_slot_maps():
    rng = random.Random(6)
    loads = {slot: rng.randrange(1, 2000) for slot in range(0, 1024, 1)}
    first = sharding.first_map(7, 1024)
    owner = sharding.balanced(first, loads, 7)
    totals = Counter()
    for slot, load in loads.items():
        totals[owner[slot]] += load
    assert max(totals.values()) - min(totals.values()) < 0.01 * sum(loads.values()) / 7
    assert sum(a != b for a, b in zip(first, owner, strict=True)) < 200  # few entries are edited
    grown = sharding.grown(owner, 7)
    moved = [new for old, new in zip(owner, grown, strict=True) if old != new]
    assert set(moved) == {7} and abs(len(moved) - 1024 / 8) < 10


def test_boosted_trees():
    cells = {(a, b): ((90, 10) if a and not b else (5, 95)) for a in range(3) for b in range(3)}
    start, trees = boosted(cells)
    score = {cell: start + sum(tree.score(cell) for tree in trees) for cell in cells}
    assert min(score[a, 0] for a in (1, 2)) > max(score[c] for c in cells if not c[0] or c[1])
    assert boosted({(0,): (5, 0)})[0] > 0 > boosted({(0,): (0, 5)})[0]
    assert threshold([(2.0, 90, 1), (1.0, 10, 50)], 0.95, 1.0) == 2.0
    assert threshold([(1.0, 0, 50)], 0.95, 1.0) == float("inf")
    assert zlib.crc32(b"") == 0


def test_joined_words_have_the_tokens_of_single_ones():
    """Latin words with marks, digits, apostrophes, blanks inside and out, and of other letters."""
    encoder = packing.word_tokens("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    draw = random.Random(9)
    chars = "abcdefgé ß'’.,!\n\t\x1c\x85\xa0019日Ω<|-"
    texts = ["".join(draw.choices(chars, k=draw.randrange(60))) for _ in range(3000)] + ["I'll  don't\n\nwe've 's", " x", "x "]
    encoder.forget()
    plain = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    for text, ids, expected in zip(texts, encoder.encode(texts), plain, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids, text


def test_latin_texts_are_encoded_whole():
    encoder = packing.word_tokens("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    draw = random.Random(5)
    chars = "abcdefghijklmnoETA éßñŁ\u023f '’'.,!\n\t\x1c\x85\xa0 019  <|>-"
    latin = ["".join(draw.choices(chars.replace("’", "").replace("|", ""), k=draw.randrange(80))) for _ in range(3000)]
    latin += ["", " ", "we've  'S\n\n x ", "zq" * 3000, " \n" * 3000, "\u00ff" * 500, "|<endoftext|>"]
    other = ["".join(draw.choices(chars + "日Ω\u0240\u024f", k=draw.randrange(80))) for _ in range(500)] + ["a <|endoftext|> b", "\u0240"]
    encoder.forget()
    for texts, some in ((latin, False), (latin[::9] + other, True)):
        plain = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for text, ids, expected in zip(texts, encoder.encode(texts), plain, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == expected.ids, text
        assert bool(encoder.now) == some
    encoder.forget()


def plain_score(model, items, start):
    """Log-likelihood of one text, token by token."""
    hidden, size = gru.HIDDEN, model.size
    state, before, total = np.zeros(hidden), start, 0.0
    for item in items:
        add, loop = model.inputs[before].astype(float), state @ model.loop.astype(float)
        reset, stay = (1 / (1 + np.exp(-(add + loop)[k * hidden : (k + 1) * hidden])) for k in (0, 1))
        fresh = np.tanh(add[2 * hidden :] + reset * loop[2 * hidden :])
        state = (1 - stay) * fresh + stay * state
        kind = item // size
        for logits, place in (
            (model.class_weights @ state + model.class_bias, kind),
            (model.item_weights[kind] @ state + model.item_bias[kind], item % size),
        ):
            total += logits[place] - np.log(np.exp(logits).sum())
        before = item
    return total


def test_scores_are_those_of_a_forward_pass():
    rng = np.random.default_rng(3)
    model = gru.Model(rng.integers(0, 50, (8, 8)).astype(float))
    texts = [rng.integers(0, 64, n).astype(np.int32) for n in (1, 700, 3, 3, 40, 250, 1, 97, 96)]
    model.train(texts, 8)
    expected = [plain_score(model, text.tolist(), 8) for text in texts]
    for count, window in ((256, 96), (3, 7), (1, 50)):
        assert model.score(texts, 8, count=count, window=window) == pytest.approx(expected, rel=1e-4)


def test_a_long_text_beside_short_ones_takes_no_more_than_its_tokens():
    rng = np.random.default_rng(3)
    model = gru.Model(np.ones((64, 64)))
    texts = [rng.integers(0, 4096, 10).astype(np.int32) for _ in range(255)] + [rng.integers(0, 4096, 1_000_000).astype(np.int32)]
    tracemalloc.start()
    gru.Windows(texts, 256, 64).window(0, 96)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    assert np.isfinite(model.score(texts[:255] + [texts[255][:20_000]], 64)).all()


def test_a_few_long_texts_make_few_windows():
    rng = np.random.default_rng(3)
    model, learnt = gru.Model(np.ones((8, 8))), []
    texts = [rng.integers(0, 64, 24).astype(np.int32) for _ in range(255)] + [rng.integers(0, 64, 24 * 400).astype(np.int32)]
    model._learn = lambda before, *rest: learnt.append(before.shape)
    model.train(texts, 8)
    assert len(learnt) < 10 and max(steps * streams for steps, streams in learnt) <= 24 * 256


def test_sums_by_row():
    rng = np.random.default_rng(4)
    rows = np.concatenate([rng.integers(0, 300, 500), np.full(200, 7), np.full(gru.MANY + 1, 311), [317]])
    values = rng.standard_normal((len(rows) + 1, 5))
    values[-1] = 0
    present, sums = gru._sums_by(rows, values, 320)
    assert sorted(present) == sorted(set(rows))
    for row, total in zip(present, sums, strict=True):
        assert np.allclose(total, values[:-1][rows == row].sum(axis=0))


def test_texts_are_read_as_words_are_defined():
    draw = random.Random(2)
    texts = ["".join(draw.choices("aAbBÉ \t\n\x0b\x0c\r\x1c\x1f\x85\xa0é日　😀", k=draw.randrange(40))) for _ in range(400)]
    texts += [None, "", " ", "a", " a", "a\n", "zq" * 500]
    expected = [lower_words(text or "") for text in texts]
    words, number = lm.words_of(pa.array(texts))
    assert list(zip(number.tolist(), words.to_pylist(), strict=True)) == [(i, w) for i, found in enumerate(expected) for w in found]
    count = Counter(word for found in expected[::2] for word in [*found, lm.END])
    common, rest = count.most_common(40), count.most_common()[40:]
    groups = {}
    for word, n in rest:
        old = groups.get(lm.bucket_of(word), (0, 0))
        groups[lm.bucket_of(word)] = (old[0] + n, old[1] + 1)
    known = lm.Vocabulary(common, count.total(), len(count), groups)
    read, common = known.read(pa.array(texts)), dict(common)
    rare = Counter()
    for text, word, n in zip(read.rare_text.tolist(), read.rare.to_pylist(), read.rare_n.tolist(), strict=True):
        rare[text, word] += n
    assert rare == Counter((i, word) for i, found in enumerate(expected) for word in found if word not in common)
    for i, found in enumerate(expected):
        items = [known.items.get(word, lm.bucket_of(word)) for word in [*found, lm.END]]
        assert read.items[i].tolist() == items == known.items_of(pa.array(texts))[i].tolist()
        base = sum(math.log10(common[word] + 0.1) for word in [*found, lm.END] if word in common)
        assert read.base[i] == pytest.approx(base - len(items) * math.log10(count.total() + 0.1 * (len(count) + 1)))
        assert read.n_known[i] == sum(word in common for word in [*found, lm.END])


def test_runs_hold_every_row_once_in_order():
    texts = ["x" * n for n in (3, 0, 20, 1, 1, 9, 0, 30, 2)] + [None, "é"]
    table = pa.table({"id": range(len(texts)), "text": texts})
    for size in (1, 4, 10, 1000):
        found = list(lm.runs(iter(table.to_batches(max_chunksize=4)), size))
        assert [x for run in found for x in run.column(1).to_pylist()] == texts
        assert all(sum(len((x or "").encode()) for x in run.column(1).to_pylist()[:-1]) < size for run in found)
        assert len(found) == 1 if size == 1000 else len(found) > 3
