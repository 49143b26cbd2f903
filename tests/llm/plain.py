"""Plain brute-force versions of the operators' definitions."""

from __future__ import annotations

import json
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text: str) -> list[str]:
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def quality(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {k for i, x in enumerate(windows) if n[x] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def shingles(text: str, k: int = 5) -> frozenset:
    w = WORD.findall(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def join(texts: dict[int, str], least: float = 0.8) -> dict[int, tuple[int, int]]:
    """doc_id to (class, links), by comparing all pairs."""
    ids, sets = sorted(texts), {i: shingles(t) for i, t in texts.items()}
    parent, links = {i: i for i in ids}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (root(i), links[i]) for i in ids}


def targets(sizes: dict, weights=(5, 2, 1), most: int = 3) -> dict:
    """Shares by weight, the excess over the caps shared again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cap = {s: most * sizes[s] for s in order}
    out, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > cap[s]}
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = cap[s]
        left -= sum(cap[s] for s in over)
        free -= over
    return out


def chat(rows, tools, chunk: int):
    """Messages in their order by (conversation, chunk), and the counts; rows are (conv_id, turn, role, text)."""
    times, schema = Counter((c, t, r, x or "") for c, t, r, x in rows), {t.name: t for t in tools}
    kinds = {str: "string", int: "integer", float: "number", bool: "boolean", dict: "object", list: "array", type(None): "null"}
    found = []
    for c, t, role, text in times:
        m = {"conv": c, "turn": t, "role": role, "content": text, "answers": None, "calls": [], "key": (c, t, role, text), "parent": None}
        got = json.loads(text) if role in ("assistant", "tool") and text.startswith("{") else {}
        if role == "tool" and (a := got.get("tool_call_id")) is not None:
            m |= {"answers": a, "content": got.get("content")}
        for x in got.get("tool_calls") or []:
            value = x["arguments"]
            try:
                value = json.loads(value) if isinstance(value, str) else value
            except ValueError:
                pass
            s, ok = schema.get(x["name"]), isinstance(value, dict)
            if ok := ok and s is not None:
                for k, v in value.items():
                    kind = kinds[type(v)]
                    ok &= not s.closed if k not in s.types else s.types[k] == kind or (s.types[k], kind) == ("number", "integer")
                ok &= set(s.required) <= set(value)
            m["calls"].append({"arguments": value if isinstance(value, str) else None if value is None else json.dumps(value, sort_keys=True, separators=(",", ":")), "id": x["id"], "name": x["name"], "valid": ok})
            m["content"] = got.get("content")
        found.append(m)
    first: dict = {}
    for m in found:
        for x in m["calls"]:
            k = (m["conv"], x["id"])
            order = lambda y: ((y["turn"] is not None, y["turn"] or 0), y["role"], y["key"][3])
            if k not in first or order(m) < order(first[k]):
                first[k] = m
    out: dict = {}
    counts = Counter({"n_messages": len(found), "n_repeats": sum(times.values()) - len(found), "n_linked": 0, "n_calls": 0, "n_invalid": 0, "n_results": 0, "n_unanswered": 0})
    for m in found:
        m["parent"] = first.get((m["conv"], m["answers"])) if m["answers"] is not None else None
    met = {(m["conv"], m["answers"]) for m in found if m["parent"]}
    for m in found:
        top, depth, seen = m, 0, set()
        while top["parent"] is not None and id(top) not in seen:
            seen.add(id(top))
            top, depth = top["parent"], depth + 1
        if top["parent"] is not None:
            top, depth = m, 0  # on a circle, or hanging on one
        line = {k: v for k, v in (("content", m["content"]), ("linked", depth > 0 if m["answers"] is not None else None), ("role", m["role"]), ("tool_call_id", m["answers"]), ("tool_calls", [{k: v for k, v in x.items() if v is not None} for x in m["calls"]] or None)) if v is not None}
        none = lambda x: (x is not None, x or 0 if not isinstance(x, str) else x)
        order = (none(top["turn"]), depth, none(m["turn"]), (m["role"] is not None, m["role"] or ""), json.dumps(line, ensure_ascii=False, separators=(",", ":")))
        out.setdefault((m["conv"], (top["turn"] or 0) // chunk), []).append((order, line))
        counts.update(n_linked=depth > 0, n_calls=len(m["calls"]), n_invalid=sum(not x["valid"] for x in m["calls"]), n_results=m["answers"] is not None, n_unanswered=sum((m["conv"], x["id"]) not in met for x in m["calls"]))
    return {k: [x for _, x in sorted(v, key=lambda y: y[0])] for k, v in out.items()}, dict(counts)
