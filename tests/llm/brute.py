"""Plain versions of the operators over lists of rows, to hold the Spark results against."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def kept_words(docs, window=20):
    first, out = {}, {}
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0, d[1] or "")):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if first.setdefault(key, (doc_id, text, i)) != (doc_id, text, i):
                gone[i : i + window] = [True] * window
        out[doc_id, text] = (len(words), sum(gone), hashlib.sha256(" ".join(w for w, g in zip(words, gone) if not g).encode()).hexdigest())
    return out


def exact_groups(docs):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for doc_id, text in docs:
        groups[norm(text)].append(doc_id)
    rows = []
    for doc_id, text in docs:
        ids = groups[norm(text)]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        rows.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return rows


def simhash(text, shingle=4):
    words = WORD.findall(az(text))
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(docs, radius=4):
    prints = [simhash(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, f"{prints[i]:016x}", least.get(root(i))) for i, (doc_id, _) in enumerate(docs)]


def shingle_set(text, k=5):
    words = WORD.findall(az(text))
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def without_similar(docs, similarity=0.8):
    """The first of each group that chains of similar texts join, by doc_id."""
    docs = sorted(docs)
    bags, label = [shingle_set(t) for _, t in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both, every = len(bags[i] & bags[j]), len(bags[i] | bags[j])
            if (both >= similarity * every) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return [d for i, d in enumerate(docs) if label[i] == i]


def contaminated(docs, items, similarity=0.8, k=5):
    def bag(words):
        return Counter(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1)))

    out = {}
    for doc_id, text in docs:
        words = WORD.findall((text or "").lower())
        for item_id, passage in items:
            theirs = WORD.findall((passage or "").lower())
            if not words or not theirs:
                continue
            b, width = bag(theirs), min(len(words), len(theirs))
            for s in range(len(words) - width + 1):
                a = bag(words[s : s + width])
                common = sum((a & b).values())
                score = common / (sum(a.values()) + sum(b.values()) - common)
                if score >= similarity - 1e-12 and score > out.get((doc_id, item_id), (0, 0))[0]:
                    out[doc_id, item_id] = (score, s)
    return out


def lm_scores(docs, folds=10, one_word=500.0, two_words=4.0, smoothing=0.1):
    """An automaton as dictionaries, each text walked word by word over arcs and failures."""
    steps = lambda t: [None, *WORD.findall(az(t)), ()]
    words, runs, texts = Counter(), Counter(), 0
    for doc_id, text in docs:
        if fold(doc_id, folds):
            s = steps(text)
            texts += 1
            words.update(s[1:])
            runs.update(zip(s, s[1:]))
            runs.update(zip(s, s[1:], s[2:]))
    n, v = sum(words.values()), len(words)
    root = lambda w: (words[w] + smoothing) / (n + smoothing * (v + 1))
    times = lambda state: texts if state == (None,) else words[state[0]] if len(state) == 1 else runs[state]
    weight = lambda state: two_words if len(state) == 2 else one_word

    def p(state, w):
        return (runs[*state, w] + weight(state) * p(state[1:], w)) / (times(state) + weight(state)) if state else root(w)

    rows = []
    for doc_id, text in docs:
        s, score, state = steps(text), 0.0, (None,)
        for i, w in enumerate(s[1:], 1):
            while state and (not times(state) or not runs[*state, w]):
                score += math.log10(weight(state) / (times(state) + weight(state)))
                state = state[1:]
            score += math.log10(p(state, w))
            state = next(c for c in (tuple(s[i - 1 : i + 1]), (w,), ()) if not c or times(c))
        rows.append((doc_id, fold(doc_id, folds) == 0, len(s) - 1, sum(words[w] > 0 for w in s[1:]), n, sum(math.log10(root(w)) for w in s[1:]), score))
    return rows


def secrets(text, primed, reach=48, least=16, around=512, novelty=0.6):
    """(kind, start, end) found by walking runs of characters one by one."""
    spans = []

    def run(at, allowed):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    ascii_low = "".join(c.lower() if c in upper else c for c in text)
    at = 0
    while at < len(text):
        end = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if ascii_low.startswith(word, at):
                i = at + len(word)
                i += text[i : i + 1] in ("'", '"') and i < len(text)
                i = run(i, " ")
                if text[i : i + 1] in (":", "=") and i < len(text):
                    i = run(i + 1, " ")
                    i += text[i : i + 1] in ("'", '"') and i < len(text)
                    stop = run(i, upper + lower + digits + "+/_.=-")
                    if stop > i:
                        end = stop
                        if stop - i >= 6:
                            spans.append(("assign", at, stop))
                        break
        at = end or at + 1
    for kind, start, allowed, size in (("access", "AKIA", upper + digits, 20), ("hex", "", "abcdef" + digits, 24)):
        at = 0
        while at < len(text):
            end = run(at + len(start), allowed) if text.startswith(start, at) else at
            if end > at + len(start) and end - at >= size:
                spans.append((kind, at, end))
            at = max(end, at + 1) if end > at + len(start) else at + 1
    words = ("password", "passwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "credential", "bearer", "authorization", "private_key", "signature")
    at, taken, novel = 0, list(spans), []
    while at < len(text):
        word = next((w for w in words if ascii_low.startswith(w, at)), None)
        if not word:
            at += 1
            continue
        end = at + len(word)
        for i in range(end, min(len(text), end + reach + 1)):
            if novel and i < novel[-1][1]:
                continue
            stop = run(i, upper + lower + digits + "+/_=.-")
            if stop - i >= least:
                body = text[i:stop]
                near = text[max(0, i - around) : i].encode() + text[stop : stop + around].encode()
                fresh = len(primed.compress(near + body.encode())) - len(primed.compress(near)) >= novelty * len(body)
                mixed = any(c in digits for c in body) and any(c.lower() in lower for c in body)
                clear = not any(i < e and s < stop for _, s, e in taken)
                novel.append((i, stop, fresh and mixed and clear))
        at = end
    spans += [("novel", a, b) for a, b, ok in novel if ok]
    order = ("assign", "access", "hex", "novel")
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (x[1], order.index(x[0]), x[2])))


def lag_ok(plan, given):
    """Whether every prefix of a cycle keeps each source within one block of its share."""
    slots, out = sum(given.values()), Counter()
    for t, (source, _, slot) in enumerate(plan, 1):
        assert slot == t - 1
        out[source] += 1
        if any(abs(out[s] - n * t / slots) >= 1 for s, n in given.items()):
            return False
    return out == Counter(given)


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(field, (*r[:4], text))))
    steps = defaultdict(list)

    def climb(nodes):
        """The root of (hash, rows below), noting the siblings on the way."""
        while len(nodes) > 1:
            runs, nodes = [nodes[i : i + 3] for i in range(0, len(nodes), 3)], []
            for run in runs:
                for i, (_, below) in enumerate(run):
                    for k in below:
                        steps[k].append(("".join(h for h, _ in run[:i]), "".join(h for h, _ in run[i + 1 :])))
                nodes.append((sha("".join(h for h, _ in run)), [k for _, below in run for k in below]))
        return nodes[0]

    trees = defaultdict(list)
    for k, r in enumerate(rows):
        trees[r[1]].append((r[0] is not None, r[0] or 0, leaf(r, r[4]), k))
    subroots = [climb([(h, [k]) for _, _, h, k in sorted(trees[s])]) for s in sorted(trees, key=lambda s: (s is not None, (s or "").encode()))]
    subroot = {k: h for h, below in subroots for k in below}
    root, out = climb(subroots)[0] if subroots else None, []
    for k, r in enumerate(rows):
        folded = leaf(r, r[4].replace("\n", "") if r[4] is not None and fold(r[0], 2) == 0 else r[4])
        for left, right in steps[k]:
            folded = sha(left + folded + right)
        out.append((r[0], leaf(r, r[4]), subroot[k], root, sha("".join(a + b for a, b in steps[k])), folded, folded == root))
    return out


def repeated_words(doc_id, text):
    """The words of a text after the planting of operator 13."""
    words = WORD.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not words:
        return words
    a = h // 10 % len(words)
    p = 1 + (len(words) - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]


def runs(words):
    """(start, length, period) of all runs by trying every period, and the words that stay."""
    n, found, gone = len(words), [], set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(words[i : j + q - r] == words[i + r : j + q] for r in range(1, q)):
                found.append((i, j + q - i, q))
                gone |= set(range(i + q, j + q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2])), [w for i, w in enumerate(words) if i not in gone]


def toxic_features(text, bits):
    """Indices of words, pairs of neighbours, and pairs with one or two words between."""
    marks = {c: None for c in range(33, 127) if not chr(c).isalnum()}
    bare = "".join(c for c in "".join(c.lower() if c.isascii() else c for c in text) if ord(c) not in marks)
    hashes = [zlib.crc32(w.encode()) for w in re.split("[ \t\n\r\x0b\x0c]+", bare) if w]
    whole, last = 1 << 64, 0xD6E8FEB86659FD93
    found = {h * last % whole for h in hashes}
    for gap, factor in ((0, 0x9E3779B97F4A7C15), (1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        for one, two in zip(hashes, hashes[gap + 1 :]):
            found.add(((one * factor + two) * last + factor) % whole)
    return {x >> (64 - bits) for x in found}


def ftrl(rows, epochs, alpha, beta, l1, l2):
    """FTRL-proximal one coordinate at a time: weights by index that are not zero, and the bias."""
    z, n = {}, {}

    def weight(at):
        s, root = z.get(at, 0.0), math.sqrt(n.get(at, 0.0))
        if at == "bias":
            return -s / ((beta + root) / alpha)
        return 0.0 if abs(s) <= l1 else -(s - math.copysign(l1, s)) / ((beta + root) / alpha + l2)

    for _ in range(epochs):
        for indices, label in rows:
            seen = [*sorted(indices), "bias"]
            w = {at: weight(at) for at in seen}
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.values()))))) - label
            if abs(error) < 1e-3:
                continue
            for at in seen:
                old = n.get(at, 0.0)
                z[at] = z.get(at, 0.0) + error - (math.sqrt(old + error * error) - math.sqrt(old)) / alpha * w[at]
                n[at] = old + error * error
    return {at: weight(at) for at in z if at == "bias" or abs(z[at]) > l1} | {"bias": weight("bias")}


def toxic_score(text, weights, bits):
    total = weights["bias"] + sum(weights.get(at, 0.0) for at in toxic_features(text, bits))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))
