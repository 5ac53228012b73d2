"""Plain Python versions of the operators, for small inputs."""
import collections
import hashlib
import math
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text, lower=True):
    t = text or ""
    return WORD.findall(t.translate(_LOWER) if lower else t)


def shingles(text, width):
    w = words(text)
    k = min(width, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def near_groups(texts, width, percent):
    """texts: list of (doc_id, text); component id per row, all pairs compared."""
    sets = [shingles(t, width) for _, t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(texts)):
        groups[find(i)].append(texts[i][0])
    ids = {r: min((x for x in m if x is not None), default=None) for r, m in groups.items()}
    return [ids[find(i)] for i in range(len(texts))]


def lm_scores(rows, held, order=3):
    """rows: list of texts; held: list of flags. Exact Witten-Bell scores without quantisation."""
    tokens = [words(t) + ["</s>"] for t in rows]
    count = [collections.Counter() for _ in range(order + 1)]
    for w, h in zip(tokens, held):
        if h:
            continue
        p = ["<s>"] * (order - 1) + w
        for i in range(len(w)):
            for n in range(1, order + 1):
                count[n][tuple(p[i + order - n : i + order])] += 1
    total, kinds = [collections.Counter() for _ in range(order + 1)], [collections.Counter() for _ in range(order + 1)]
    for n in range(2, order + 1):
        for g, c in count[n].items():
            total[n][g[:-1]] += c
            kinds[n][g[:-1]] += 1
    big_n, v = sum(count[1].values()), len(count[1])
    out = []
    for w in tokens:
        p = ["<s>"] * (order - 1) + w
        base = score = 0.0
        for i in range(len(w)):
            q = (count[1][(w[i],)] + 0.1) / (big_n + 0.1 * (v + 1))
            base += math.log10(q)
            for n in range(2, order + 1):
                g = tuple(p[i + order - n : i + order])
                if total[n][g[:-1]]:
                    q = (count[n][g] + kinds[n][g[:-1]] * q) / (total[n][g[:-1]] + kinds[n][g[:-1]])
            score += math.log10(q)
        out.append((len(w), sum((x,) in count[1] for x in w), big_n, base, score))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _pii_ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        twice = [int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(d))]
        return 16 <= len(d) <= 19 and sum(twice) % 10 == 0
    return kind != "phone" or 8 <= len(d) <= 15


def pii(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(r, text or "") if _pii_ok(k, m.group())] for k, r in PII.items()}


def pii_digest(text):
    found = pii(text)
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k in PII for s, e in found[k]).encode()).hexdigest()


def quality(text):
    t = text or ""
    w = words(t, lower=False)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    win = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if win[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def mixing_names(rows):
    """rows: (id, other columns as texts or None): the name that each one is drawn by."""
    import collections as c

    ids, seen, out = c.Counter(r[0] for r in rows), c.Counter(), []
    for r in rows:
        if r[0] is not None and ids[r[0]] == 1:
            out.append(str(r[0]))
            continue
        digest = hashlib.md5(":".join("null" if x is None else str(x) for x in r[1:]).encode()).hexdigest()
        seen[r[0], digest] += 1
        out.append(f"{'null' if r[0] is None else r[0]}#{digest}#{seen[r[0], digest]}")
    return out


def poisson_count(seed, doc_id, stratum, rate):
    key = f"{seed}:rate:{'null' if doc_id is None else doc_id}:{stratum}"
    u = ((int(hashlib.sha256(key.encode()).hexdigest()[:15], 16) >> 8) + 0.5) / (1 << 52)
    p = c = math.exp(-rate)
    k = 0
    while c < u:
        k += 1
        p *= rate / k
        c += p
    return k


def _digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def fingerprint(text):
    import xxhash

    w = words(text)
    k = min(3, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def close_groups(prints, errors=2):
    """Root of every 64-bit number, all pairs compared."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= errors:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def simhash(rows):
    """rows: (doc_id, text) -> (doc_id, fingerprint, component_id) in their order."""
    f = [fingerprint(t) for _, t in rows]
    distinct = sorted(set(f))
    root = dict(zip(distinct, close_groups(distinct)))
    low = {}
    for (d, _), x in zip(rows, f):
        if d is not None:
            low[root[x]] = min(low.get(root[x], d), d)
    return [(d, f"{x:016x}", low.get(root[x])) for (d, _), x in zip(rows, f)]


def trie(rows, heads=9, family=5):
    """rows: (conv_id, turn, role, text) -> the trie's rows, by plain dictionaries."""
    import zlib

    conv = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append(((t is not None, t or 0, _digest(r or "", x or "")), (r or "", x or "")))
    seq = {c: [turn for _, turn in sorted(v)] for c, v in conv.items()}
    whole = {}
    for c in seq:
        h = zlib.crc32(str(c).encode()) % heads
        whole[c] = tuple(seq.get(c - int(math.fmod(c, family)), [])[:h] + seq[c][h:])
    members, kids = collections.defaultdict(list), collections.defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, m in members.items():
        ends = hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)).encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], ends))
    return out


def cheapest_edits(rows):
    """rows: (initial, must be deleted, truncated) -> least (cost, audit)."""
    import functools

    turn = (2, 2, 3, 2)
    kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    @functools.cache
    def best(i, state, inserted):
        ways = [(0, "")] if i == len(rows) and state in (0, 3) else []

        def way(cost, letter, rest):
            if rest:
                ways.append((cost + rest[0], letter + rest[1]))

        if inserted < 3:
            way(5, "I", best(i, turn[state], inserted + 1))
        if i < len(rows):
            initial, gone, cut = rows[i]
            way(2, "D", best(i + 1, state, 0))
            if not gone:
                if (initial, state) in kept:
                    way(5 * cut, "K", best(i + 1, kept[initial, state], 0))
                way(1 + 5 * cut, "R", best(i + 1, turn[state], 0))
        return min(ways, default=None)

    for i in range(len(rows), 0, -50):  # from the end, so that no call goes deep
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def repair(rows):
    """rows: (conv_id, turn, role, text) -> the repaired conversations' rows."""
    import zlib

    conv = collections.defaultdict(list)
    for c, t, r, x in rows:
        r, x, kept = " " if r is None else r, " " if x is None else x, conv[c]
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        order = (t is not None, t or 0, _digest(r, x))
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        kept += [(order, copy, t, "user" if kind == 4 else r, x) for copy in range({0: 0, 3: 2}.get(kind, 1))]
    out = []
    for c, v in conv.items():
        v.sort(key=lambda e: e[:2])
        turns = {e[2] for e in v if e[2] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults, coded, seen = collections.Counter(), [], set()
        for _, _, _, r, x in v:
            shown = x.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not shown else "duplicate" if (r, x) in seen else "truncated" if shown[-1] not in ".!?" else None
            faults[fault] += 1
            seen.add((r, x))
            coded.append((r[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        cost, audit = cheapest_edits(tuple(coded))
        said, rest, after_s = [], iter(v), False
        for letter in audit:
            role = ("user", "assistant")[(len(said) - after_s) % 2]
            if letter == "I":
                said.append(f"{role}:")
                continue
            _, _, _, r, x = next(rest)
            if letter == "K":
                after_s |= r[0] == "s"
                said.append(f"{r}:{x}")
            elif letter == "R":
                said.append(f"{role}:{x}")
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out.append((c, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return out
