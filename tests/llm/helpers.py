"""Plain versions of what the operators compute, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def components(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def alike(sets, percent):
    """Pairs of keys whose sets have a Jaccard similarity of percent or more, by an inverted index."""
    index, out, items = defaultdict(list), [], [(k, s) for k, s in sets if s]
    for i, (key, found) in enumerate(items):
        shared = Counter(j for x in found for j in index[x])
        for x in found:
            index[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(found) + len(items[j][1]) - n):
                out.append((key, items[j][0]))
    return out


#: Texts that every operator must take: null, empty, white space, ties, one word, no letters, other scripts, very long.
ODD = [None, "", "   ", "\n\n", "word", "word", "12 34 !!", "日本語のテキスト です", "a b", "A B", "one\ttwo three", "x" * 5000, "long words here " * 4000]


def odd_documents(spark, extra=True):
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "s", i, "clash") for i, t in enumerate(ODD)]
    rows += [(4, "word", "en", "s", 0, "clash"), (None, "no id at all", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank string")
    return df.withColumnRenamed("rank", "size") if not extra else df
