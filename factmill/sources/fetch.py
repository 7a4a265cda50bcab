"""Polite fetching as a plug-in: the engine never opens a connection itself.

``Politeness`` wraps a transport given by the user: one retry on server errors, waits on
429 and stops altogether after a run of them; robots rules are kept per host.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit

Transport = Callable[[str], tuple[int, str]]


class Stopped(Exception):
    """Too many refusals in a row."""


def allowed(robots: str, path: str, agent: str = "*") -> bool:
    """Whether rules let the agent read the path; the longest matching rule decides, allow on ties."""
    best, verdict, ours, fresh = -1, True, False, True
    for line in robots.splitlines():
        key, _, value = line.split("#")[0].partition(":")
        key, value = key.strip().lower(), value.strip()
        if key == "user-agent":
            ours = (value == "*" or value.lower() in agent.lower()) or (ours and not fresh)
            fresh = False
        elif key in ("allow", "disallow"):
            fresh = True
            if ours and value and path.startswith(value) and (len(value) > best or len(value) == best and key == "allow"):
                best, verdict = len(value), key == "allow"
    return verdict


def crawl_delay(robots: str, agent: str = "*") -> float | None:
    """The delay that rules ask of the agent, in seconds."""
    ours, fresh, delay = False, True, None
    for line in robots.splitlines():
        key, _, value = line.split("#")[0].partition(":")
        key, value = key.strip().lower(), value.strip()
        if key == "user-agent":
            ours = (value == "*" or value.lower() in agent.lower()) or (ours and not fresh)
            fresh = False
        elif key:
            fresh = True
            if key == "crawl-delay" and ours:
                try:
                    delay = float(value)
                except ValueError:
                    continue
    return delay


@dataclass
class Politeness:
    transport: Transport
    wait: Callable[[float], None] = time.sleep
    pause: float = 1.0
    limit: int = 5
    refused: int = 0
    robots: dict[str, str] = field(default_factory=dict)
    between: float = 0.0
    asked: set[str] = field(default_factory=set)

    def get(self, url: str) -> tuple[int, str]:
        if self.refused >= self.limit:
            raise Stopped(url)
        host = urlsplit(url)
        rules = self.robots.get(host.netloc, "")
        if not allowed(rules, host.path or "/"):
            return 403, ""
        if host.netloc in self.asked:  # the longer of our own pause and the one asked for
            self.wait(max(self.between, crawl_delay(rules) or 0.0))
        self.asked.add(host.netloc)
        for attempt in (0, 1):
            try:
                status, body = self.transport(url)
            except OSError:
                status, body = 599, ""
            if status == 429:
                self.refused += 1
                self.wait(self.pause * 2**self.refused)
                if self.refused >= self.limit:
                    raise Stopped(url)
            elif status < 500:
                self.refused = 0
                return status, body
            if attempt == 0:
                self.wait(self.pause)
        return status, body
