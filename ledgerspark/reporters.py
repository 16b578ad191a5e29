"""Progress and results for a terminal."""

from __future__ import annotations

import sys
import threading
import time
from typing import TextIO

from .logs import decimal, duration, middle

#: Seconds between two pictures of the spinner.
STEP = 0.22
FRAMES = "|/-\\"


def line(event: dict) -> str:
    """What is shown of an event."""
    name = event.get("event", "progress").replace("_", " ")
    told = [str(event[k]) for k in ("dataset", "step") if event.get(k)]
    told += [f"{decimal(event[k])} {k.replace('_', ' ')}" for k in ("rows", "batch_rows", "quarantined", "files", "chunks", "placeholders") if event.get(k)]
    if event.get("seconds"):
        told.append(duration(1000 * event["seconds"]))
    if event.get("message"):
        told.append(middle(event["message"], 120))
    return f"{name}: {', '.join(told)}" if told else name


class Reporter:
    """Shows events: on a terminal the last one with a spinner, redrawn in place; elsewhere a line each."""

    def __init__(self, out: TextIO | None = None):
        self.out = out or sys.stderr
        self.live = bool(getattr(self.out, "isatty", lambda: False)())
        self.text, self.done, self.lock = "", threading.Event(), threading.Lock()
        if self.live:
            threading.Thread(target=self._spin, daemon=True).start()

    def _spin(self) -> None:
        began = time.time()
        while not self.done.wait(STEP):
            with self.lock:
                if self.text:
                    self.out.write(f"\r\x1b[K{FRAMES[int((time.time() - began) / STEP) % len(FRAMES)]} {self.text}")
                    self.out.flush()

    def __call__(self, event: dict) -> None:
        with self.lock:
            self.text = line(event)
            if not self.live:
                self.out.write(self.text + "\n")
            elif event.get("event", "").endswith(("_completed", "_failed", "_finished")):
                self.out.write(f"\r\x1b[K{self.text}\n")
                self.text = ""
            self.out.flush()

    def close(self) -> None:
        self.done.set()
        if self.live:
            self.out.write("\r\x1b[K")
            self.out.flush()


def summary(title: str, values: dict) -> str:
    """A title and a line for each value; lists of dictionaries as indented lines."""
    out = [title]
    for key, value in values.items():
        name = key.replace("_", " ")
        if isinstance(value, list) and value and isinstance(value[0], dict):
            out.append(f"  {name}:")
            out += ["    " + ", ".join(f"{k.replace('_', ' ')} {decimal(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v}" for k, v in x.items()) for x in value]
        elif key == "seconds":
            out.append(f"  time: {duration(1000 * value)}")
        else:
            out.append(f"  {name}: {decimal(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else ', '.join(map(str, value)) if isinstance(value, list) else value}")
    return "\n".join(out)
