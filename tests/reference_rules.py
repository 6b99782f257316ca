"""The rules in plain Python, one conversation at a time, to check the Spark forms against."""

from __future__ import annotations

import json
import re

NBSP_BLANK = " 　"


def normal_form(raw):
    """Normalised list of (role, content), or None. `raw` is JSON text or a list of dicts."""
    if isinstance(raw, str):
        try:
            raw = json.loads(raw)
        except ValueError:
            return None
    if not isinstance(raw, list) or not raw or not all(isinstance(m, dict) for m in raw):
        return None
    spoken = lambda m: isinstance(m.get("content"), str) and m["content"].strip() != ""
    if any(not spoken(m) and m.get("role") == "assistant" and m.get("tool_calls") for m in raw):
        return None
    heard = [(m.get("role"), m["content"]) for m in raw if spoken(m)]
    places = [i for i, (role, _) in enumerate(heard) if role in ("user", "assistant")]
    if not places:
        return None
    before = [text for role, text in heard[: places[0]] if role == "system"]
    chat = [heard[i] for i in places]
    roles = "".join(role[0] for role, _ in chat)
    if not re.fullmatch("(ua)+", roles):
        return None
    if before:
        chat[0] = ("user", before[-1] + "\n\n" + chat[0][1])
    return chat


def measures(chat, script: str, min_chars: int = 5):
    text = " ".join(content for _, content in chat)
    return {
        "n_chars": len(text),
        "n_stripped": len(text.strip()),
        "n_script": len(re.findall(script, text)),
        "has_short": any(len(content.strip()) < min_chars for _, content in chat),
    }


def scan(flags, target):
    """Which rows are selected and which scanned when rows are taken in this order."""
    taken, selected, scanned = 0, [], []
    for flag in flags:
        looked = taken < target
        scanned.append(looked)
        selected.append(looked and bool(flag))
        taken += looked and bool(flag)
    return selected, scanned


def next_fit(lengths, capacity):
    bins, used, number = [], 0, -1
    for length in lengths:
        if number < 0 or used + length > capacity:
            number, used = number + 1, 0
        used += length
        bins.append(number)
    return bins
