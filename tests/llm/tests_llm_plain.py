"""Plain versions of pipeline stages, shared by tests."""

from test_jaccard import plain
from test_spans import plain as plain_cut

from sluice.llm.jaccard import Similar
from sluice.llm.spans import Run


def plain_near(docs, words, percent):
    component = {k: c for k, _, c in plain(docs, Similar(words, percent))}
    return [(k, t) for k, t in docs if component[str(k)] == k]


def plain_spans(docs):
    out = []
    for k, (text, _, removed) in plain_cut(docs, Run()).items():
        if not (removed and not (text or "").strip()):
            out.append((k, text))
    return sorted(out)


def plain_leaks(docs, items):
    """Documents that hold no item's beginning, and those that hold a whole item word for word."""
    squeeze = lambda x: " ".join((x or "").lower().split())
    dropped = [(k, t) for k, t in docs if any(squeeze(i) in squeeze(t) for i in items)]
    return [d for d in docs if d not in dropped], dropped
