import random
import re

from odd_texts import ODD

from tripcast.llm import licenses

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORDS.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licenses.PHRASES.items():
        want = phrase.split()
        places += [(label, i) for i in range(len(words)) if words[i:i + len(want)] == want]
    blocks = set()
    half = licenses.BLOCK // 2
    for b in range(0, max(1, -(-len(words) // half))):
        own = set(words[b * half:b * half + licenses.BLOCK])
        for label, t in licenses.TEMPLATES:
            ws = set(t.split())
            if own and len(own & ws) >= -int(-licenses.THRESHOLD * len(ws) // 1):
                blocks.add((label, b * half))
    return len(words), sorted(places), blocks


def check(docs_of, texts):
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(texts, clash=True)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, places, blocks = brute(t)
        assert got[i]["n_words"] == n
        assert sorted((p["label"], p["word"]) for p in got[i]["places"]) == places
        assert {(b["label"], b["word"]) for b in got[i]["blocks"]} == blocks, (i, t)
    return got


def test_matches_brute_force(docs_of):
    rng = random.Random(5)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["foo", "bar", "été"]
    texts = ODD + ["Released UNDER the MIT license.", "x under the\n mit licensed", "cc-by-nc 4.0 CC BY NC",
                   "éunder the mit license", "under the mit license under the mit license"]
    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 150))
        at = rng.randint(0, len(words))
        words[at:at] = rng.choice(licenses.TEMPLATES)[1].split()
        texts.append(" ".join(words))
    check(docs_of, texts)


def test_summary(docs_of):
    texts = ["nothing here", "Licensed under CC BY-NC 4.0", None,
             "this work is licensed under the gnu general public license, version 3."]
    out = {r["doc_id"]: r for r in licenses.summary(licenses.scan(docs_of(texts))).collect()}
    assert (out[0]["labels"], out[0]["score"], out[0]["first_word"]) == ("", 0.0, None)
    assert (out[1]["n_base"], out[1]["first_word"], out[1]["base_labels"], out[1]["score"]) == (1, 2, "cc-by-nc", 1.0)
    assert out[2]["n_words"] == 0
    assert (out[3]["n_base"], out[3]["labels"]) == (0, "gpl-3") and out[3]["score"] > 0.9
    assert licenses.scan(docs_of([])).count() == 0
