"""Brute-force counterparts of the operators, in plain Python, and plan inspection."""

import hashlib

ROLES = {"system": "System", "user": "Human", "assistant": "Assistant"}


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def turn_order(turn):
    _, number, role, text = turn
    return tuple((value is not None, value) for value in (number, role, text))


def conversations(turns):
    """{conv_id: [(role, text), ...]} in turn order."""
    folded = {}
    for turn in sorted(turns, key=turn_order):
        folded.setdefault(turn[0], []).append((turn[2], turn[3]))
    return folded


def chatml(messages):
    return "".join(
        "<|im_start|>" + (role or "user") + "\n" + (text or "") + "<|im_end|>\n"
        for role, text in messages
    )


def plain(messages):
    shown = [(role or "user", text or "") for role, text in messages]
    return "\n\n".join(f"{ROLES[role]}: {text}" for role, text in shown if role in ROLES)


def complete(messages):
    return bool(messages) and all(r in ROLES and t is not None for r, t in messages)


def cut(text, n):
    """The text up to the end of its n-th whitespace-separated piece."""
    position = pieces = 0
    while position < len(text):
        start = position
        while start < len(text) and text[start].isspace():
            start += 1
        if start == len(text):
            return text
        if pieces == n:
            return text[:position]
        while start < len(text) and not text[start].isspace():
            start += 1
        position, pieces = start, pieces + 1
    return text


def training_texts(turns, n):
    return {
        conv: (cut(chatml(m) if complete(m) else plain(m), n), not complete(m))
        for conv, m in conversations(turns).items()
    }


def batch_plan(keys, seed, epochs, micro, accum):
    """Rows of the plan for single-column keys, copies included."""
    seen = {}
    numbered = []
    for key in keys:
        seen[key] = seen.get(key, -1) + 1
        numbered.append((key, seen[key]))
    rows = []
    for epoch in range(epochs):

        def digest(item, epoch=epoch):
            key, copy = item
            text = f"{seed}:{epoch}:{'' if key is None else key}{f'#{copy}' if copy else ''}"
            return hashlib.md5(text.encode()).hexdigest()

        for pos, (key, _) in enumerate(sorted(numbered, key=digest)):
            rows.append((epoch, pos, key, pos // micro, pos // (micro * accum), len(numbered)))
    return rows
