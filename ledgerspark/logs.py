"""Structured logs: one JSON file a command, JSON lines for progress; and how figures are shown."""

from __future__ import annotations

import json
import os
import re
from datetime import datetime, timezone

LEVELS = ("debug", "info", "warning", "error")

# Events that are not of level info.
DEBUG = {"batch_committed", "materialization_dataset_heartbeat", "preparing_progress"}
WARNING = {"batch_retry_fallback", "row_quarantined"}
ERROR = {"archive_failed", "command_failed", "file_failed", "import_failed", "materialization_dataset_failed"}


def level_of(event: str, default: str = "info") -> str:
    for level, events in (("debug", DEBUG), ("warning", WARNING), ("error", ERROR)):
        if event in events:
            return level
    return default


def entry(payload, event: str = "log_entry", command: str | None = None, status: str | None = None, message: str | None = None, now: datetime | None = None) -> dict:
    """payload in its envelope. What the payload says of event, level, time, command, status and message goes first."""
    body = dict(payload) if isinstance(payload, dict) else {"payload": payload}
    named = lambda k: body[k] if isinstance(body.get(k), str) and body[k].strip() else None
    name = (named("event") or named("kind") or event).strip().replace("-", "_")
    level = next((body[k] for k in ("level", "severity") if body.get(k) in LEVELS), None) or level_of(name)
    at = named("timestamp") or (now or datetime.now(timezone.utc)).isoformat(timespec="milliseconds").replace("+00:00", "Z")
    own = {"command": named("command") or command, "status": named("status") or status, "message": named("message") or message}
    return body | {"timestamp": at, "level": level, "severity": level, "event": name, "kind": (named("kind") or name).replace("-", "_")} | {k: v for k, v in own.items() if v}


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-")


# Commands that are named with one or two words more.
TWO_WORDS, THREE_WORDS = {"quarantine"}, {"database"}


def command_label(words: list[str]) -> str:
    """How a command is called in the names of logs."""
    words = [w for w in words if w.strip()]
    plain = next((i for i, w in enumerate(words) if w.startswith("-")), len(words))
    most = 3 if words and words[0] in THREE_WORDS else 2 if words and words[0] in TWO_WORDS else 1
    if not plain:
        return "cli"
    return "-".join(words[:most]) if plain >= most else words[0]


def write_command(folder: str, command: str, payload, status: str = "success", message: str | None = None) -> str:
    """The path of the log that was written."""
    os.makedirs(folder, exist_ok=True)
    now = datetime.now(timezone.utc)
    path = os.path.join(folder, f"{now:%Y%m%d-%H%M%S}-{now.microsecond:06d}-{slug(command)}.json")
    event = "command_failed" if status == "error" else "command_completed"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(entry(payload, event, command, status, message, now), f, indent=2, default=str)
    return path


def append_line(path: str, payload, **more) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(entry(payload, **more), default=str) + "\n")


def decimal(value: float, digits: int = 2) -> str:
    text = f"{value:,.{digits}f}"
    return text.rstrip("0").rstrip(".") if "." in text else text


def size(n: float) -> str:
    if n < 1024:
        return f"{n} B"
    power = 1
    while power < 4 and n >= 1024 ** (power + 1):
        power += 1
    x = n / 1024**power
    return f"{x:.{0 if x >= 100 else 1 if x >= 10 else 2}f} {('KB', 'MB', 'GB', 'TB')[power - 1]}"


def duration(ms: float) -> str:
    if ms < 1000:
        return f"{round(ms)} ms"
    minutes, seconds = divmod(ms / 1000, 60)
    hours, minutes = divmod(int(minutes), 60)
    parts = [f"{hours}h"] * (hours > 0) + [f"{minutes}m"] * (hours > 0 or minutes > 0)
    return " ".join([*parts, f"{decimal(seconds)}s"]) if parts else f"{decimal(seconds)} s"


def middle(text: str, most: int) -> str:
    """At most about so many characters, the middle left out."""
    edge = max(6, (most - 3) // 2)
    return text if len(text) <= most else f"{text[:edge]}...{text[-edge:]}"
