"""Plain Python versions of the operators' contracts, and the odd rows they are tested on."""

import random
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, "
          "score string, n string, piece string, kept string, ids string, n_email string")


def odd_rows(seed: int = 3) -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeats, clashing extra columns."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeö.é,") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    base = " ".join(rnd.choices(words, k=120))
    texts = [None, "", " ", "\n\n", "one", "one two three", base, base, base.upper(), base + " tail",
             base.replace(words[0], "zzz"), "word " * 4000, " ".join(rnd.choices(words, k=9000)),
             "mail a.b@c-d.org, b@c@d.e f@g.h@i.j x@y +49 (30) 1234-5678 +1 2 1.2.3.4.5 999.1.1.1 "
             "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000000000000 +12 a@b.c-",
             "IBAN: DE89 3704 0044 0532 0130 00, account no 12 passport=X1234567 https://x.y/z?a=b). "
             "mailto:q@w.er ssn 078-05-1120 SSN 5", "a\n\nb\na\n a\nb c",
             "x" * 5000, "tab\tand\x0bvt  two  blanks\n", "<|endoftext|> a<|endoftext|>b <s> ▁▁ é́ \U0001f600",
             "#*$%&|<> # * ok", "you idiot. He said idiot. not an idiot"]
    texts += [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(40)]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 50, t, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", None]),
                     None if t is None else len(t), "x", None, "y", "z", None, "w", "v"))
    rows += [rows[6]] * 3 + [(None, *rows[7][1:]), (None, *rows[0][1:]), (None, *rows[0][1:])]
    return rows


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def components(rows, k, percent):
    """[(doc_id, n_shingles, component_id)] of [(doc_id, text)] by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in groups[root(i)] if x is not None]
        out.append((d, len(sets[i]), (min(known) if known else None) if sets[i] else d))
    return out


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = 0
                for i, c in enumerate(reversed(digits)):
                    v = int(c) * (2 if i % 2 else 1)
                    total += v - 9 if v > 9 else v
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            out.append((kind, m.start(), m.end()))
    return out


def statistics(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = {}
    for i, x in enumerate(windows):
        seen.setdefault(x, []).append(i)
    covered = {p + d for places in seen.values() if len(places) > 1 for p in places for d in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x),
            len(lines) - len(set(lines)), len(covered))


def merkle(rows, bad=()):
    """[(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)] of field dicts; rows whose place
    in ``rows`` is in ``bad`` are tampered (n_chars plus one)."""
    from hashlib import sha256

    def h(s):
        return sha256(s.encode()).hexdigest()

    def one(r):
        fields = [r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][i:i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    def proof(levels, at):
        out = []
        for level in levels[:-1]:
            sib = at ^ 1
            out.append((at % 2, level[sib] if sib < len(level) else ""))
            at //= 2
        return out

    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, one(r), i))
    trees = {k: (sorted(v), tree([x[2] for x in sorted(v)])) for k, v in groups.items()}
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    top = tree([trees[k][1][-1][0] for k in order]) if order else []
    out = []
    for at_top, k in enumerate(order):
        for at, (_, _, leaf, i) in enumerate(trees[k][0]):
            path = proof(trees[k][1], at) + proof(top, at_top)
            changed = dict(rows[i])
            if i in bad and changed["n_chars"] is not None:
                changed["n_chars"] += 1
            cur = one(changed)
            for right, sib in path:
                cur = h(sib + cur if right else cur + sib)
            out.append((rows[i]["doc_id"], leaf, trees[k][1][-1][0], top[-1][0],
                        h("".join(s for _, s in path)), cur, cur == top[-1][0]))
    return out


def damage(rows):
    """Rows (conv_id, turn, role, text) after the damage."""
    import zlib
    out = []
    for c, t, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        pick = zlib.crc32(":".join(" " if v is None else str(v) for v in (c, t)).encode()) % 20
        if pick == 1:
            text = ""
        if pick == 2:
            text = re.sub("[.!?]", "", text)
        if pick == 4:
            role = "user"
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(pick, 1)
    return out


def repair_one(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired rows) of one conversation's damaged
    rows, by dynamic programming from the end: cheapest, then least audit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        last = WORD.findall(text)[-1][-1] if WORD.search(text) else ""
        faults.append("blank" if not last else "duplicate" if (role, text) in seen
                      else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # ways from (row, initials so far as the pattern's state) to the end
    best = {(len(rows), q): (0, "", ()) if q in "-a" else None for q in "-sua"}
    for i in range(len(rows), -1, -1):
        now = {q: ([best[i, q]] if (i, q) in best and best[i, q] else []) for q in "-sua"}
        if i < len(rows):
            _, _, role, text = rows[i]
            extra = 3 if faults[i] == "truncated" else 0
            for q in "-sua":
                c, a, r = best[i + 1, q] or (10 ** 9, "", ())
                now[q].append((c + 4, "D" + a, r))
                want = "a" if q == "u" else "u"
                if faults[i] not in ("blank", "duplicate"):
                    if role[:1] == want or (role[:1] == "s" and q == "-"):
                        c, a, r = best[i + 1, role[0]] or (10 ** 9, "", ())
                        now[q].append((c + extra, "K" + a, ((role, text), *r)))
                    c, a, r = best[i + 1, want] or (10 ** 9, "", ())
                    now[q].append((c + 3 + extra, "R" + a, (({"u": "user", "a": "assistant"}[want], text), *r)))
        for _ in range(4):  # inserts stay in the row
            for q in "-sua":
                want = "a" if q == "u" else "u"
                if now[want]:
                    c, a, r = min(now[want])
                    now[q].append((c + 3, "I" + a, (({"u": "user", "a": "assistant"}[want], ""), *r)))
        for q in "-sua":
            best[i, q] = min(now[q]) if now[q] else None
    cost, audit, done = best[0, "-"]
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, list(done))


def near(rows, threshold):
    """{place: (n_links, component_id, kept)} of (vec_id, vector, label) rows by comparing all pairs."""
    import numpy as np

    def whole(v):
        return (v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)
                and any(x != 0 for x in v))

    links = {i: set() for i in range(len(rows))}
    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            w, b = rows[j][1:]
            if a is None or a != b or not whole(v) or not whole(w) or len(v) != len(w):
                continue
            x, y = np.array(v, dtype=float), np.array(w, dtype=float)
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold - 1e-12:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in links:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        known = [rows[j][0] for j in reach if rows[j][0] is not None]
        low = min(known) if known else None
        out[i] = (len(links[i]), low, rows[i][0] is not None and rows[i][0] == low)
    return out
