"""Problem 5: noise in text read from scanned pages.

Words are grouped by the skeleton that their confusable glyphs leave; within a group the form
that the collection (in texts that were not scanned) or the text itself supports, and that a few
misreadings explain, is the right one. Lines equal but for digits and misread glyphs are running headers. The text is then
reflowed. Vocabulary counts cover all texts and all words. They stay a table: the words that
blocks of scanned texts ask for, and the forms those may be misread from, are joined with it,
so a task holds the counts of its block only and every word keeps its count at every size.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import textkit as K
from .neardup import chunks

# What a scanner reads for what was printed.
MISREADS = [("0", "o"), ("1", "i"), ("1", "l"), ("|", "l"), ("|", "i"), ("!", "l"), ("!", "i"), ("5", "s"), ("9", "g"), ("6", "b"), ("8", "b"), ("c", "e"), ("f", "t"), ("b", "h"), ("ri", "n"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("vv", "w"), ("ü", "ti"), ("h", "li"), ("w", "vi"), ("m", "in"), ("é", "e")]
# Of these, single letters for single letters: a typing error looks the same, so they need more support.
WEAK = {("c", "e"), ("f", "t"), ("b", "h"), ("é", "e"), ("h", "li"), ("w", "vi"), ("m", "in")}
# Words that no title ends with.
OPEN_END = frozenset("a an and the of on in for from to with among at by or its their".split())
HYPHENS = "-­¬‐‑"
WORD = re.compile(r"(?:[^\W_]|[|!](?=[^\W_])|(?<=[^\W_])[|](?=[\s.,;:)]|$)|(?<=[a-z])!(?=[\s.,;:)]|$))+")
MARK = re.compile(r"[019568|!]")
PAGE = re.compile(r"^\W*(?:(?:page|p|pp)\b\W*)?[0-9lIO|]{1,4}(?:\s*(?:/|of|-)\s*[0-9lIO|]{1,4})?[^\w.]*$", re.I)
_SKEL = str.maketrans("015|!968", "olsllgbb")


def is_scanned(text: str, width: int = 100) -> bool:
    """Texts broken into lines of a page's width: little of it stands in longer lines."""
    lines = text.split("\n")
    if len(lines) < 2:
        return False
    size = [len(x.strip()) for x in lines]
    total = sum(size)
    wrapped = any(a >= 35 and b for a, b in zip(size, size[1:]))
    return total > 0 and wrapped and sum(x for x in size if x > width) < 0.25 * total


def skeleton(line: str) -> str:
    """Letters of a line with confusable glyphs merged; digits and signs left out."""
    s = line.lower().translate(_SKEL)
    s = s.replace("rn", "m").replace("cl", "d").replace("vv", "w").replace("ii", "u").replace("ri", "n")
    return re.sub(r"[\W\d_]+", "", s).replace("c", "e").replace("i", "l").replace("f", "t").replace("b", "h")


def bare_header(line: str) -> tuple[str, bool]:
    """(line without a page number at either end, whether one was set off by a sign)."""
    m = re.match(r"^(.*?\S)\s*[|·–—]\s*[0-9lIO]{1,4}\s*$", line) or re.match(r"^\s*[0-9lIO]{1,4}\s*[|·–—]\s*(\S.*)$", line)
    if m:
        return m[1], True
    m = re.match(r"^(.*\S)\s+[0-9lIO]{1,4}\s*$", line) or re.match(r"^\s*[0-9lIO]{1,4}\s+(\S.*)$", line)
    return (m[1] if m else line), False


def furniture(lines: list[str], references: bool) -> set[int]:
    """Indices of running headers and page numbers."""
    out = set()
    live = [i for i, x in enumerate(lines) if x.strip()]
    bones: dict[int, str] = {}

    def bone(i: int) -> str:
        if i not in bones:
            bones[i] = skeleton(lines[i])
        return bones[i]

    heads: dict[str, list[int]] = {}
    strong: set[str] = set()
    for p, i in enumerate(live):
        x = lines[i].strip()
        if PAGE.match(x) and any(c.isdigit() for c in x):
            out.add(i)
            continue
        if len(x) > 80:
            continue
        body, sign = bare_header(x)
        sk = bone(i) if body == x else skeleton(body)
        if len(sk) < 8:
            continue
        if sign:
            strong.add(sk)
        if body[:1].isupper() or body[:1].isdigit() or sign:
            heads.setdefault(sk, []).append(i)
    for sk, at in heads.items():
        numbered = any(bare_header(lines[i].strip())[0] != lines[i].strip() for i in at)
        ends = all(lines[i].rstrip().endswith((".", ",", ";", ":")) for i in at)
        if sk in strong or (len(at) > 1 and not ends and not (references and re.search(r"\d;\d|\(\d", lines[at[0]]))):
            out.update(at)
            strong.add(sk)
        elif numbered and not ends:
            pass
    # A header may stand once: then it is the start of the title that follows, or of another line.
    for p, i in enumerate(live):
        if i in out:
            continue
        x = lines[i].strip()
        if not strong and (x[-1] in ".,;" or len(x) > 75):
            continue
        body, _ = bare_header(x)
        numbered = body != x
        sk = skeleton(body) if numbered else bone(i)
        if len(sk) < 8:
            continue
        if sk in strong:
            out.add(i)
            continue
        if x[-1] in ".,;" or len(x) > 75:
            continue
        rest = "".join(bone(j) for j in live[p + 1 : p + 5])
        after = rest.startswith(sk)
        before = numbered and p > 0 and any("".join(bone(j) for j in live[q : q + 3]).startswith(sk) for q in range(min(p, 4)) if live[q] not in out or q == 0)
        if after or before:
            out.add(i)
            continue
        # A fragment at the head of a page: it breaks the sentence around it or breaks off itself.
        at_page = p == 0 or live[p - 1] in out and PAGE.match(lines[live[p - 1]].strip())
        if not at_page or not (x[:1].isupper() or numbered) or p + 1 >= len(live):
            continue
        nxt = lines[live[p + 1]].strip()
        prev = next((lines[j].rstrip() for j in reversed(live[:p]) if j not in out), ".")
        fresh = nxt[:1].isupper() or bool(re.match(r"\[?\d+[.\])]\s", nxt))
        open_end = body.split()[-1].lower() in OPEN_END or numbered or (body.isupper() and not nxt.isupper())
        if references and re.match(r"\[?\d+[.\])]\s", x):
            continue
        if p == 0:
            if fresh and (open_end or (references and re.match(r"\[?\d+[.\])]\s", nxt))):
                out.add(i)
        elif (prev[-1:] not in ".?!" and nxt[:1].islower()) or (prev[-1:] in ".?!" and fresh):
            out.add(i)
    return out


_STROKES = str.maketrans({"0": "o", "1": "l", "5": "s", "|": "l", "!": "l", "9": "g", "6": "ll", "8": "ll", "é": "e", "ü": "tl", "c": "e", "f": "t", "i": "l", "r": "l", "n": "ll", "u": "ll", "h": "ll", "b": "ll", "m": "lll", "d": "el", "w": "vl"})


def word_skeleton(w: str) -> str:
    """The glyphs of a lower-cased word with what MISREADS confuses merged: upright strokes are
    counted, so a printed word and any misreading of it have one skeleton."""
    return w.replace("vv", "w").translate(_STROKES)


def misreading(read: str, printed: str, most: int = 4) -> tuple[int, int, bool] | None:
    """(misreadings, kinds of them, whether a weak one is among them) by which ``printed`` was
    read as ``read``, with the fewest misreadings; None if it takes more than ``most``."""
    best: dict[tuple[int, int], tuple[int, frozenset]] = {(0, 0): (0, frozenset())}
    for i in range(len(read) + 1):
        for j in range(len(printed) + 1):
            at = best.get((i, j))
            if at is None:
                continue
            steps = [(i + 1, j + 1, 0, None)] if i < len(read) and j < len(printed) and read[i] == printed[j] else []
            steps += [(i + len(bad), j + len(good), 1, (bad, good)) for bad, good in MISREADS if at[0] < most and read.startswith(bad, i) and printed.startswith(good, j)]
            for x, y, cost, kind in steps:
                new = (at[0] + cost, at[1] | {kind} if kind else at[1])
                old = best.get((x, y))
                if old is None or (new[0], len(new[1])) < (old[0], len(old[1])):
                    best[x, y] = new
    end = best.get((len(read), len(printed)))
    return (end[0], len(end[1]), any(k in WEAK for k in end[1])) if end and end[0] else None


def asked_words(text: str, gone: set[int]) -> set[str]:
    """Every word whose count line_noise and kept_lines look up for a scanned text."""
    lines = text.split("\n")
    body = [i for i, x in enumerate(lines) if x.strip() and i not in gone]
    out: set[str] = set()
    for p, i in enumerate(body):
        out.update(w.lower() for w in WORD.findall(lines[i]))
        x = lines[i].strip()
        if x[-1] in HYPHENS and p + 1 < len(body):
            left, right = re.search(r"([^\W_|!]+).$", x), re.match(r"\s*([^\W_]+)", lines[body[p + 1]])
            if left and right:
                a, b = left[1], right[1]
                out.update(w.lower() for w in (a, b, a + b, f"{a}-{b}"))
    return out


def may_be_misread(w: str, own: int) -> bool:
    """Whether other forms are looked up for a word counted ``own`` times."""
    return own < 3 and len(w) >= 3 and not w.isdigit() and "-" not in w


Form = tuple[str, int, int, int, bool]  # printed form, its count, misreadings, kinds, weak


class Vocabulary:
    """Counts of words in the texts that were not scanned, and for words that may be misread
    the forms of their skeleton. Without ``forms`` they are looked up among the words given."""

    def __init__(self, counts: dict[str, int], forms: dict[str, list[Form]] | None = None) -> None:
        self.n, self.forms = counts, forms
        self.groups: dict[str, list[str]] = {}
        if forms is None:
            for w in counts:
                self.groups.setdefault(word_skeleton(w), []).append(w)

    def printed(self, w: str) -> list[Form]:
        if self.forms is not None:
            return self.forms.get(w, [])
        found = ((c, misreading(w, c)) for c in self.groups.get(word_skeleton(w), ()) if c != w)
        return [(c, self.n[c], *m) for c, m in found if m]

    def intended(self, word: str, here: Counter, names: bool = False, near: dict[str, list[str]] | None = None) -> str | None:
        """The supported form of a misread word; None where the word may stand as it is.

        Forms of one skeleton are weighed by their count in the collection and, three times as
        much, in the same text (``here``; ``near``: its seldom words by skeleton). Weak or
        several kinds of misreading need more support, unless a digit or sign marks the word.
        names: the text lists persons, so a capitalised word with letters only may be a
        misspelt name and needs a sign of misreading.
        """
        w = word.lower()
        if names and word[:1].isupper() and not MARK.search(w) and not re.search("rn|cl|ii|vv|ri|ü", w):
            return None
        own = self.n.get(w, 0)
        if not may_be_misread(w, own):
            return None
        marked = bool(MARK.search(w)) and any(c.isalpha() for c in w)
        best, support = None, 0
        for c, n, times, kinds, weak in self.printed(w):
            if MARK.search(c):
                continue
            least = 1 if marked and kinds == 2 else 30 if weak or (kinds > 1 and not marked) else 4
            if kinds > 2 and (n < 30 or len(w) < 7):
                continue
            if n > support and n >= least and n > 10 * own:
                best, support = c, n
        for c in (near or {}).get(word_skeleton(w), ()):
            if c == w or MARK.search(c) or here[c] * 3 <= support:
                continue
            m = misreading(w, c)
            if m and m[1] == 1 and (marked or (not m[2] and here[c] >= 2 * here.get(w, 1))):
                best, support = c, here[c] * 3
        if best is None and marked and re.fullmatch(r"[a-zà-ÿ]+[0|!159][a-zà-ÿ]+[0|!159a-zà-ÿ]*", w):
            best = w.translate(str.maketrans("0159|!", "olsgll"))
        return best

    def by_skeleton(self, here: Counter) -> dict[str, list[str]]:
        """A text's words that the collection hardly knows, by skeleton."""
        out: dict[str, list[str]] = {}
        for w in here:
            if self.n.get(w, 0) < 4 and len(w) > 2:
                out.setdefault(word_skeleton(w), []).append(w)
        return out

    def divided(self, left: str, sign: str, right: str) -> bool:
        """Whether a hyphen at a line's end divides one word."""
        if sign != "-":
            return True
        whole, kept = self.n.get((left + right).lower(), 0), self.n.get(f"{left}-{right}".lower(), 0)
        if whole or kept:
            return whole >= kept
        if right[:1].isupper() and not left.isupper():
            return False
        l, r = self.n.get(left.lower(), 0), self.n.get(right.lower(), 0)
        return not (l >= 5 and r >= 5 and len(left) > 3 and len(right) > 3)


def line_noise(text: str, vocab: Vocabulary, references: bool = False, gone: set[int] | None = None) -> list[tuple[int, str]]:
    """(line number, kind) of every noisy line of a scanned text; ``gone``: its furniture, if known."""
    if gone is None and not is_scanned(text):
        return []
    lines = text.split("\n")
    gone = furniture(lines, references) if gone is None else gone
    out = [(i + 1, "furniture") for i in gone]
    body = [i for i, x in enumerate(lines) if x.strip() and i not in gone]
    here = Counter(w.lower() for i in body for w in WORD.findall(lines[i]))
    near = vocab.by_skeleton(here)
    for p, i in enumerate(body):
        x = lines[i].rstrip()
        tail = None
        if x and x[-1] in HYPHENS and p + 1 < len(body):
            left = re.search(r"([^\W_|!]+)[%s]$" % HYPHENS, x)
            right = re.match(r"\s*([^\W_]+)", lines[body[p + 1]])
            if left and right and vocab.divided(left[1], x[-1], right[1]):
                out.append((i + 1, "hyphen"))
                tail = (left[1], right[1])
        ws = WORD.findall(x)
        if tail and ws:
            ws = ws[:-1]
        if p and lines[body[p - 1]].rstrip()[-1:] in HYPHENS and ws:
            ws = ws[1:]
        bad = any(vocab.intended(w, here, references, near) for w in ws)
        if tail and not bad:
            bad = bool(MARK.search(tail[0]) and vocab.intended("".join(tail), here, references, near))
        if bad:
            out.append((i + 1, "ocr"))
    return out


def kept_lines(text: str, vocab: Vocabulary, gone: set[int]) -> list[tuple[int, str, bool, bool]]:
    """(line number, text, glued to the line before, starts a paragraph) of the lines of a scanned
    text that are no furniture; the hyphen of a divided word is gone."""
    lines = text.split("\n")
    width = max(len(x) for x in lines)
    out: list[tuple[int, str, bool, bool]] = []
    gap = False
    for i, x in enumerate(lines):
        x = x.strip()
        if i in gone:
            continue
        if not x:
            gap = True
            continue
        if not out:
            out.append((i + 1, x, False, True))
        else:
            n, before, g, st = out[-1]
            starts = gap and (before[-1:] in ".?!:" or len(before) < width // 2)
            glued = False
            if not starts and before[-1:] in HYPHENS:
                left, nxt = re.search(r"([^\W_|!]+).$", before), re.match(r"([^\W_]+)", x)
                glued = True
                if left and nxt and vocab.divided(left[1], before[-1], nxt[1]):
                    out[-1] = (n, before[:-1], g, st)
            out.append((i + 1, x, glued, starts))
        gap = False
    return out


def corrected(text: str, vocab: Vocabulary, references: bool = False) -> str:
    """Misread words of a reflowed text put right; their case is kept."""
    here = Counter(w.lower() for w in WORD.findall(text))
    near = vocab.by_skeleton(here)

    def right(m: re.Match) -> str:
        good = vocab.intended(m[0], here, references, near)
        if good is None:
            return m[0]
        return good.upper() if m[0].isupper() and len(m[0]) > 1 else good[:1].upper() + good[1:] if m[0][:1].isupper() else good

    return WORD.sub(right, text)


def with_skeletons(words: DataFrame) -> DataFrame:
    """(w, n, s): words with a digest of their skeleton."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"w": f["w"], "n": f["n"], "s": [word_skeleton(w) for w in f["w"]]})

    return words.mapInPandas(run, "w string, n long, s string").select("w", "n", F.xxhash64("s").alias("s"))


def vocabulary(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """(w, n, s): counts over all texts that were not scanned, of words and hyphenated
    compounds, with their skeletons."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in chunks(batches, "t"):
            cp, _ = K.codes([t for t in f["t"] if t and not is_scanned(t)] or [""])
            s, e, h, lc = K.words(cp)
            if not len(s):
                continue
            pair = np.flatnonzero((s[1:] == e[:-1] + 1) & (cp[e[:-1]] == 45))
            h2 = K.span_hash(K.prefix_hash(lc), s[pair], e[pair + 1])
            s, e, h = np.append(s, s[pair]), np.append(e, e[pair + 1]), np.append(h, h2)
            _, i, n = np.unique(h, return_index=True, return_counts=True)
            raw = lc.tobytes().decode("utf-32-le", "surrogatepass")
            yield pd.DataFrame({"w": [raw[a:b] for a, b in zip(s[i].tolist(), e[i].tolist())], "n": n})

    both = None
    for df, c in frames:
        part = df.where(F.col(c).isNotNull()).select(F.col(c).alias("t")).mapInPandas(count, "w string, n long")
        both = part if both is None else both.union(part)
    return cut(with_skeletons(both.groupBy("w").agg(F.sum("n").alias("n"))))


def scanned_texts(df: DataFrame, references: bool) -> DataFrame:
    """(id, t, gone) of the scanned texts of (id, t); gone: the indices of furniture."""

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            g = f[[is_scanned(t) for t in f["t"]]]
            gone = [sorted(furniture(t.split("\n"), references)) for t in g["t"]]
            yield g.assign(gone=pd.Series(gone, index=g.index, dtype=object))

    return df.mapInPandas(find, "id long, t string, gone array<int>")


def judged(texts: DataFrame, words: DataFrame | Vocabulary, ask: Callable[[str, set[int]], set[str]], judge: Callable[[int, str, set[int], Vocabulary], list[tuple]], schema: str, chars: int = 200_000) -> DataFrame:
    """The rows of judge(id, text, gone, vocabulary) for every text of (id, t, gone).

    The vocabulary holds the words that ``ask`` names for the text's block (about ``chars``
    characters of texts) and the forms of their skeleton that explain them, with full counts.
    """
    if isinstance(words, Vocabulary):
        words = with_skeletons(texts.sparkSession.createDataFrame(list(words.n.items()), "w string, n long"))
    names = [c.split()[0] for c in schema.split(", ")]

    def block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in chunks(frames, "t", chars):
            first = f"{f['id'].iloc[0]} {f['t'].iloc[0]}".encode("utf-8", "surrogatepass")
            yield f.assign(g=int.from_bytes(hashlib.blake2b(first, digest_size=8).digest(), "little", signed=True))

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = {(g, k) for g, t, gone in zip(f["g"], f["t"], f["gone"]) for k in ask(t, set(gone))}
            yield pd.DataFrame(list(rows), columns=["g", "k"])

    def skeletons(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            use = [may_be_misread(k, n) for k, n in zip(f["k"], f["n"])]
            g = f[use]
            yield pd.DataFrame({"s": [word_skeleton(k) for k in g["k"]], "k": g["k"]})

    def explained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(k, w, n, *m) for k, w, n in zip(f["k"], f["w"], f["n"]) if k != w and (m := misreading(k, w))]
            yield pd.DataFrame(rows, columns=["k", "w", "n", "times", "kinds", "weak"])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own = right[right["w"].isna()]
        forms: dict[str, list[Form]] = {}
        for k, *form in zip(*(right[~right["w"].isna()][c].tolist() for c in ("k", "w", "n", "times", "kinds", "weak"))):
            forms.setdefault(k, []).append((form[0], int(form[1]), int(form[2]), int(form[3]), bool(form[4])))
        v = Vocabulary(dict(zip(own["k"], own["n"].astype(int))), forms)
        return pd.DataFrame([r for i, t, gone in zip(left["id"], left["t"], left["gone"]) for r in judge(i, t, set(gone), v)], columns=names)

    blocks = cut(texts.mapInPandas(block, "g long, id long, t string, gone array<int>"))
    asked = cut(blocks.mapInPandas(keys, "g long, k string").distinct())
    own = cut(asked.select("k").distinct().join(words.select(F.col("w").alias("k"), "n"), "k", "left").select("k", F.coalesce("n", F.lit(0)).alias("n")))
    read = own.where("n < 3").mapInPandas(skeletons, "s string, k string").select(F.xxhash64("s").alias("s"), "k")
    printed = words.where("w NOT LIKE '%-%'").select("w", "n", "s")
    other = cut(read.join(printed, "s").select("k", "w", "n").mapInPandas(explained, "k string, w string, n long, times int, kinds int, weak boolean"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("w", "string"), ("times", "int"), ("kinds", "int"), ("weak", "boolean"))]
    known = own.where("n > 0").select("k", none[0], "n", *none[1:]).unionByName(other)
    counts = asked.join(known, "k").select("g", "k", "w", "n", "times", "kinds", "weak")
    return blocks.groupBy("g").cogroup(counts.groupBy("g")).applyInPandas(run, schema)


def noise_lines(df: DataFrame, id_col: str, text_col: str, words: DataFrame | Vocabulary, references: bool = False) -> DataFrame:
    """(record_id, line_no, noise_kind), each once; null and unscanned texts have none."""

    def judge(i: int, t: str, gone: set[int], v: Vocabulary) -> list[tuple]:
        return [(i, n, k) for n, k in line_noise(t, v, references, gone)]

    src = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return judged(scanned_texts(src, references), words, asked_words, judge, "record_id long, line_no int, noise_kind string").distinct()


def repair(df: DataFrame, id_col: str, text_col: str, words: DataFrame | Vocabulary, references: bool = False) -> DataFrame:
    """(record_id, text, scanned): every text once, scanned ones repaired; null stays null.

    Tasks only judge lines; SQL windows number the paragraphs and aggregation reflows them.
    Ids delivered twice give one row, of the delivery that sorts first.
    """

    def judge(i: int, t: str, gone: set[int], v: Vocabulary) -> list[tuple]:
        return [(i, *r) for r in kept_lines(t, v, gone)]

    def right(i: int, t: str, gone: set[int], v: Vocabulary) -> list[tuple]:
        return [(i, corrected(t, v, references), True)]

    def own_words(t: str, gone: set[int]) -> set[str]:
        return {w.lower() for w in WORD.findall(t)}

    src = cut(df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(text_col).alias("t")))
    scans = cut(scanned_texts(src.where("t IS NOT NULL"), references))
    lines = cut(judged(scans, words, asked_words, judge, "id long, line_no int, line string, glued boolean, starts boolean"))
    whole = src.join(scans.select("id"), "id", "left_anti").select("id", F.col("t").alias("text"), F.lit(False).alias("scanned"))
    number = F.sum(F.col("starts").cast("int")).over(Window.partitionBy("id").orderBy("line_no"))
    lead = F.when(F.col("glued") | F.col("starts"), "").otherwise(" ")
    parts = lines.withColumn("p", number).groupBy("id", "p").agg(F.array_sort(F.collect_list(F.struct("line_no", F.concat(lead, F.col("line")).alias("x")))).alias("l"))
    paragraphs = parts.select("id", "p", F.array_join(F.transform("l", lambda e: e["x"]), "").alias("text"))
    flowed = paragraphs.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("p", "text"))).alias("ps")).select("id", F.array_join(F.transform("ps", lambda e: e["text"]), "\n\n").alias("t"), F.array().cast("array<int>").alias("gone"))
    flowed = judged(flowed, words, own_words, right, "id long, text string, scanned boolean")
    blank = scans.select("id").join(lines.select("id").distinct(), "id", "left_anti").select("id", F.lit("").alias("text"), F.lit(True).alias("scanned"))
    return whole.unionByName(flowed).unionByName(blank).withColumnRenamed("id", "record_id")
