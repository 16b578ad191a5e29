"""The stored configuration: the default warehouse."""

from __future__ import annotations

import json
import os

from .errors import ValidationError


def config_path() -> str:
    return os.environ.get("LEDGERSPARK_CONFIG") or os.path.join(os.path.expanduser("~"), ".config", "ledgerspark", "config.json")


def read() -> dict:
    try:
        with open(config_path(), encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return {}


def write(config: dict) -> None:
    os.makedirs(os.path.dirname(config_path()), exist_ok=True)
    with open(config_path(), "w", encoding="utf-8") as f:
        json.dump(config, f, indent=2)


def set_warehouse(path: str) -> None:
    if not path.strip():
        raise ValidationError("the warehouse path is empty")
    write(read() | {"warehouse": path})


def reset() -> None:
    write({})


def warehouse_path(given: str | None = None) -> str:
    path = given or read().get("warehouse")
    if not path:
        raise ValidationError("no warehouse path is given or configured")
    return path
