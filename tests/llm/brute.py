"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import duckdb

SMALL = "/root/testdata/sf0.001"


def documents(folder=SMALL):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY 1").fetchall()


def table(folder, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{name}.parquet' ORDER BY 1").fetchall()


def lower(text):
    return re.sub("[A-Z]", lambda match: match.group().lower(), text or "")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[k:] for k in range(width)]))


def components(rows, width, percent):
    """For each row: size of its set, and the smallest doc_id that links reach."""
    sets = [shingles(text, width) for _, text in rows]
    holders = collections.defaultdict(list)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        common = collections.Counter(j for one in own for j in holders[one])
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for one in own:
            holders[one].append(i)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        lowest[root(i)] = min(lowest.get(root(i), doc_id), doc_id)
    return [(doc_id, len(own), lowest[root(i)]) for i, ((doc_id, _), own) in enumerate(zip(rows, sets))]


def without_repeats(texts, length, keep_first):
    """Sizes and digest of each text without the bytes that a repeated string covers."""
    counts, first = collections.Counter(), {}
    for d, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            counts[text[i : i + length]] += 1
            first.setdefault(text[i : i + length], (d, i))
    out = []
    for d, text in enumerate(texts):
        covered = bytearray(len(text))
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            if counts[window] > 1 and not (keep_first and first[window] == (d, i)):
                covered[i : i + length] = b"\1" * length
        kept = bytes(byte for byte, gone in zip(text, covered) if not gone)
        spans = sum(1 for i, gone in enumerate(covered) if gone and not (i and covered[i - 1]))
        out.append((len(text), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_spans(text):
    """(start, number of the kind, end) by the patterns as they are given."""
    text = text or ""
    found = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in re.sub("[^0-9]", "", m.group())]
        doubled = [n if k % 2 == 0 else n * 2 - 9 * (n > 4) for k, n in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def contamination(rows, items, percent=80):
    """(doc_id, item_id) to the best (common, -start, size) over all windows of as many words."""
    def bag_of(words):
        width = min(5, len(words))
        return list(zip(*[words[k:] for k in range(width)])) if words else []

    def words(text):
        return [word for word in re.split(r"[\W_]+", (text or "").lower()) if word]

    out = {}
    for item_id, text in items:
        item = bag_of(words(text))
        if not item:
            continue
        width, bag = len(item[0]), collections.Counter(item)
        for doc_id, document in rows:
            own = words(document)
            runs = list(zip(*[own[k:] for k in range(width)]))
            for start in range(len(runs) - len(item) + 1):
                if width == 5 and not any(run in bag for run in runs[start : start + len(item)]):
                    continue
                common = sum((collections.Counter(runs[start : start + len(item)]) & bag).values())
                if (100 + percent) * common >= 2 * percent * len(item):
                    best = (common, -start, len(item))
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), best), best)
    return out


def without_templates(rows, depth=3, least=3):
    """Texts without the lines of templates that recur in documents of different lines."""
    def parsed(line):
        line = re.sub(r"[^ \t\n\r\v\f]*[0-9][^ \t\n\r\v\f]*", "<*>", lower(line))
        return tuple(re.findall(r"[^ \t\n\r\v\f]+", line))

    documents = {row: frozenset(filter(None, map(parsed, (row[1] or "").split("\n")))) for row in rows}
    leaves, holders = collections.defaultdict(set), collections.defaultdict(list)
    for row in rows:
        for line in documents[row]:
            leaves[len(line), line[:depth]].add(line)
            holders[len(line), line[:depth]].append(row)
    names = collections.defaultdict(set)
    for leaf, lines in leaves.items():
        if len(holders[leaf]) < least or len(set(holders[leaf])) == 1:
            continue
        shared = collections.Counter(place for line in lines for place in enumerate(line))
        needed = -(-7 * leaf[0] // 10)
        more = {}
        for line in lines:
            often = sorted((shared[place] for place in enumerate(line) if shared[place] > 1), reverse=True)
            names[line].add(line)
            if len(often) >= needed:
                kept = frozenset(p for p in enumerate(line) if shared[p] > 1 and shared[p] >= often[needed - 1])
                names[line] = {(leaf, kept)}
                more[line] = kept
        known = {name for line in more for name in names[line]}
        for line, kept in more.items():
            if len(kept) > needed:
                names[line] |= {(leaf, kept - {place}) for place in kept} & known
    different = collections.defaultdict(set)
    for lines in documents.values():
        for line in lines:
            for name in names[line]:
                different[name].add(lines)
    out = []
    for row in rows:
        text, lines = row[1], (row[1] or "").split("\n")
        gone = [any(len(different[name]) >= least for name in names[parsed(line)]) for line in lines]
        full = [bool(parsed(line)) for line in lines]
        whole = not any(gone) or gone == full
        out.append((row[0], text if whole else "\n".join(line for line, g in zip(lines, gone) if not g)))
    return out


def short_copies(rows, items, percent=80):
    """doc_ids of documents that have fewer runs of words than an item and are alike to it as a whole."""
    words = lambda text: [word for word in re.split(r"[\W_]+", (text or "").lower()) if word]
    out = set()
    for _, text in items:
        width = min(5, len(words(text)))
        bag = collections.Counter(zip(*[words(text)[k:] for k in range(width)]))
        for doc_id, document in rows:
            own = collections.Counter(zip(*[words(document)[k:] for k in range(width)]))
            if 0 < own.total() < bag.total():
                if (100 + percent) * (own & bag).total() >= percent * (own.total() + bag.total()):
                    out.add(doc_id)
    return out


def language_model(rows, target, smoothing=10.0):
    """(doc_id, words, target loss, background loss, score) by counts of all words and pairs."""
    texts = [(i in target, [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]) for i, text in rows]
    words, pairs = ({True: collections.Counter(), False: collections.Counter()} for _ in range(2))
    own_words, own_pairs, seen = [], [], {True: 0, False: 0}
    for own, text in texts:
        start = [""] if text else []
        own_words.append(collections.Counter(start + text))
        own_pairs.append(collections.Counter(zip(start + text, text)))
        words[own] += own_words[-1]
        pairs[own] += own_pairs[-1]
        seen[own] += len(text)
    least = min((n for n in seen.values() if n), default=1)
    different = len((set(words[True]) | set(words[False])) - {""})
    out = []
    for k, (own, text) in enumerate(texts):
        loss = {}
        for model in (True, False):
            scale = least / max(seen[model], 1)
            without = lambda all_counts, mine, key: scale * (
                all_counts[model][key] - (mine[k][key] if own == model else 0)
            )
            loss[model] = 0.0
            for before, word in zip([""] + text, text):
                plain = (without(words, own_words, word) + 1) / (scale * seen[model] + different)
                both = without(pairs, own_pairs, (before, word)) + smoothing * plain
                loss[model] -= math.log(both / (without(words, own_words, before) + smoothing))
            loss[model] /= max(len(text), 1)
        out.append((rows[k][0], len(text), loss[True], loss[False], loss[True] - loss[False]))
    return out
