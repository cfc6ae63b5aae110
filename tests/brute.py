"""Plain Python versions of the operators, to hold results against on small data."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from datetime import UTC, datetime, timedelta, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo

DIGITS = str.maketrans("٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "0123456789" * 2)


def label(text):
    return " ".join(re.findall("[a-z0-9]+", text.lower()))


def flat(v):
    if isinstance(v, dict):
        return " ".join(flat(x) for x in v.values())
    if isinstance(v, list):
        return " ".join(flat(x) for x in v)
    return str(v).lower() if isinstance(v, bool) else str(v)


def drift(items, files):
    """items: dicts with attachment_id, the five fields and raw_row; files: (attachment_id, feed, file_no)."""
    kinds = {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object"}
    fields = ("sn", "nupco_code", "description", "uom", "qty_raw")
    hits, total = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    seen = defaultdict(lambda: defaultdict(set))
    for r in items:
        try:
            row = json.loads(r["raw_row"])
        except (TypeError, ValueError):
            continue
        for key, v in row.items():
            name = label(key)
            seen[r["attachment_id"]][name] |= set() if v is None else {kinds[type(v)]}
            if v is not None:
                total[name] += 1
                for f in fields:
                    text = re.sub("[^0-9]", "", flat(v)) if f == "nupco_code" else flat(v)
                    hits[name][f] += text == r[f]
    role = {n: f for n, by in hits.items() for f, k in by.items() if 2 * k > total[n]}
    by_feed = defaultdict(dict)
    for a, feed, no in files:
        by_feed[feed][no] = a
    out = set()
    for numbers in by_feed.values():
        for no, a in numbers.items():
            if no - 1 not in numbers:
                continue
            new, old = ({role.get(n, ("own", n)): (n, t) for n, t in sorted(seen[x].items(), reverse=True)} for x in (a, numbers[no - 1]))
            out |= {(a, "added", new[k][0]) for k in new.keys() - old.keys()} | {(a, "removed", old[k][0]) for k in old.keys() - new.keys()}
            for k in new.keys() & old.keys():
                if new[k][0] != old[k][0]:
                    out.add((a, "renamed", new[k][0]))
                if new[k][1] and old[k][1] and new[k][1] != old[k][1]:
                    out.add((a, "retyped", new[k][0]))
    return out


def snapshot_changes(rows):
    """rows: (snapshot_no, post_id, content_hash, is_listed, last_seen_at)."""
    best = {}
    for no, key, digest, listed, seen in rows:
        at = datetime.fromisoformat(seen)
        if (no, key) not in best or at > best[no, key][0]:
            best[no, key] = (at, None if digest is None else digest.strip().lower(), listed)
    numbers = sorted({n for n, _ in best})
    out = set()
    for a, b in zip(numbers, numbers[1:]):
        old, new = ({k: v[1:] for (n, k), v in best.items() if n == x} for x in (a, b))
        out |= {(b, k, "added") for k in new.keys() - old.keys()} | {(b, k, "removed") for k in old.keys() - new.keys()}
        out |= {(b, k, "changed") for k in new.keys() & old.keys() if new[k] != old[k]}
    return out


def value(v):
    v = "" if v is None else v.strip()
    return m[1] if (m := re.fullmatch(r"([+-]?\d+)\.0*", v)) else v


def versions(rows):
    """rows: (id, post_id, field, old_value, new_value, changed_at)."""
    stamp = lambda t: t.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ") if t else ""
    by, start = defaultdict(list), {}
    for i, post, field, old, new, at in set(rows):
        t = datetime.fromisoformat(at)
        if field == "_record":
            start[post] = min(t, start.get(post, t))
        else:
            by[post, field].append((t, i, value(old), value(new)))
    out = set()
    for (post, field), own in by.items():
        own.sort()
        got = [(start.get(post), own[0][2])]
        for t, _, _, new in own:
            if new != got[-1][1]:
                got.append((t, new))
        ends = [t for t, _ in got[1:]] + [None]
        out |= {(post, field, stamp(t), stamp(e), v) for (t, v), e in zip(got, ends)}
    return out


UNIT = {
    "ml": ("ml", 1), "cl": ("ml", 10), "l": ("ml", 1000), "ltr": ("ml", 1000), "litre": ("ml", 1000), "mm": ("mm", 1), "cm": ("mm", 10), "m": ("mm", 1000), "mtr": ("mm", 1000), "meter": ("mm", 1000),
    "mg": ("mg", 1), "g": ("mg", 1000), "gm": ("mg", 1000), "gram": ("mg", 1000), "kg": ("mg", 10**6), "kilogram": ("mg", 10**6),
    "مل": ("ml", 1), "لتر": ("ml", 1000), "ملم": ("mm", 1), "متر": ("mm", 1000), "ملغ": ("mg", 1), "غم": ("mg", 1000), "كغم": ("mg", 10**6),
    **{e: ("each", 1) for e in ("ea", "each", "unit", "nos", "piece", "pcs")},
}
TIMES = {"pair": 2, "prs": 2, "dozen": 12, "doz": 12, "dz": 12, "درزن": 12, "hundred": 100, "gross": 144, "thousand": 1000, "thous": 1000, "k": 1000, "million": 10**6}


def number(text, dots):
    parts = re.split(r"([^0-9])", text)
    out = parts[0]
    for sep, digits in zip(parts[1::2], parts[2::2]):
        groups = len(digits) == 3 and (sep != "." or dots)
        out += digits if groups else "." + digits
    return Decimal(out)


def amount(qty_raw, uom, dots):
    """(base unit, amount) or None."""
    words = lambda s: re.findall(r"[^\W\d_]+", s)
    nums = lambda s: re.findall(r"\d+(?:[.,٬]\d+| \d{3}(?!\d))*", s)
    q, u = (qty_raw or "").translate(DIGITS).lower(), (uom or "").translate(DIGITS).lower()
    if not nums(q):
        return None
    total = number(nums(q)[0], dots)
    unit = next((UNIT[w] for w in words(q) if w in UNIT), None)
    mult = next((TIMES[w] for w in words(q) if w in TIMES), None)
    total *= mult or 1
    content = number(nums(q)[1], dots) if len(nums(q)) > 1 else None
    if unit or content:
        base, factor = unit or ("each", 1)
        return base, total * (content or 1) * factor
    base, factor = next((UNIT[w] for w in words(u) if w in UNIT), ("each", 1))
    content = number(nums(u)[0], dots) if nums(u) else 1
    own = next((TIMES[w] for w in words(u) if w in TIMES), None)
    return base, total * factor * content * (own if own and own != mult else 1)


MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def instant(text, source):
    """UTC text or None."""
    t = text.translate(DIGITS).strip()
    show = lambda x: x.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    if re.fullmatch(r"\d{5,18}", t):
        n = int(t)
        for limit, unit in ((11, 1), (14, 10**3), (17, 10**6), (99, 10**9)):
            if len(t) <= limit:
                return show(datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=n // unit))
    t = re.sub(r"^[A-Z][a-z]{2}, ", "", t)
    m = re.match(r"(\d{1,2})[/.](\d{1,2})[/.](\d{4})|(\d{4})-(\d\d)-(\d\d)|(\d{1,2})[ -]([A-Za-z]{3})[ -](\d{4})", t)
    if not m:
        return None
    if m[1]:
        d, mo, y = int(m[1]), int(m[2]), int(m[3])
    elif m[4]:
        y, mo, d = int(m[4]), int(m[5]), int(m[6])
    else:
        d, mo, y = int(m[7]), MONTHS.index(m[8].lower()) + 1, int(m[9])
    rest = t[m.end():]
    h = mi = s = 0
    if c := re.match(r"[T ](\d{1,2}):(\d\d)(?::(\d\d))?(?:\.\d+)?\s*(AM|PM|ص|م)?", rest):
        h, mi, s = int(c[1]), int(c[2]), int(c[3] or 0)
        if c[4]:
            h = h % 12 + (12 if c[4] in ("PM", "م") else 0)
        rest = rest[c.end():]
    try:
        wall = datetime(y, mo, d, h, mi, s)
    except ValueError:
        return None
    rest = rest.strip()
    if z := re.fullmatch(r"(Z|UTC|GMT)?(?:([+-])(\d{1,2}):?(\d\d)?)?", rest):
        if rest:
            off = timedelta(hours=int(z[3] or 0), minutes=int(z[4] or 0)) * (-1 if z[2] == "-" else 1)
            return show(wall.replace(tzinfo=timezone(off)))
        zone = {"nupco": "Asia/Riyadh", "joneps": "Asia/Amman"}[source]
    else:
        zone = {"(Riyadh time)": "Asia/Riyadh", "(KSA time)": "Asia/Riyadh", "(Amman time)": "Asia/Amman"}.get(rest, rest)
    return show(wall.replace(tzinfo=ZoneInfo(zone), fold=0))
