"""The divergence of sources against brute force."""

import re
from collections import Counter, defaultdict

from cases import ROWS, write
from marquee.llm import divergence
from marquee.llm.divergence import Settings, audit, terms_of

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, least, top=50):
    """Every row of the audit of (text, lang, source) rows."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source, terms = lang or "", source or "", plain_terms(text)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        counts[lang,].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(key):
            total = sum(counts[key][t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[key][t] + 5) // total for t in kept}

        q = shares((lang,))
        p = {g: shares(g) for g in groups if g[0] == lang}
        for g in p:
            pairs = [(-sum(abs(p[g][t] - p[h][t]) for t in kept), h[1].encode()) for h in p if h != g]
            terms = [(q[t] - p[g][t], t.encode()) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(*g, part, item.decode(), -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


def test_terms():
    text = "The DOG's tail--ÄÖ_x 12a\x00b İ ſ\x85z {y}~`q"
    assert terms_of(text.encode()) == Counter(t.encode() for t in plain_terms(text))


def test_cases(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 7)
    rows = ROWS + [(100 + i, f"Ünder über a{chr(97 + i % 7)} b{chr(97 + i % 3)} über", "de", f"s{i % 5}") for i in range(60)]
    rows += [(None, "x y", "fr", s) for s in ("a", "b", None)]
    docs = write(spark, rows, tmp_path / "docs")
    for settings in (Settings(), Settings(least=2, top=3), Settings(least=1)):
        got = sorted(tuple(r) for r in audit(docs, settings).collect())
        assert got == plain([r[1:] for r in rows], settings.least, settings.top)
    assert audit(docs.limit(0)).count() == 0


def test_blocks_of_sources(spark, tmp_path, monkeypatch):
    """Many sources, in blocks and slices of terms."""
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "CELLS", 10)
    rows = [(i, " ".join(f"w{chr(97 + j)}" for j in range(i % 13)), "en", f"s{i % 11}") for i in range(90)]
    docs = write(spark, rows, tmp_path / "docs")
    assert sorted(tuple(r) for r in audit(docs, Settings(least=3)).collect()) == plain([r[1:] for r in rows], 3)
