"""What a scorer is, and the one that asks a service over HTTP."""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import Any, Protocol

logger = logging.getLogger(__name__)


class Scorer(Protocol):
    """Answers a list of ``{"url_hash", "text"}`` items with a list of dicts.

    Answers are matched to items by their ``url_hash``: order does not matter, the
    last of several counts, and an item without an answer is reported as missing. A
    scorer that sets ``positional = True`` instead answers item by item, ``None``
    standing for no answer, which keeps items of equal ``url_hash`` apart.
    """

    def __call__(self, items: list[dict[str, str]]) -> list[dict[str, Any]]: ...


#: Made once per partition and asking thread, on the executor; must be picklable or importable there.
ScorerFactory = Callable[[], Scorer]


def _new_session():
    try:
        import requests
    except ImportError as missing:
        raise ImportError("HttpScorer needs `requests`, or a session of your own") from missing
    return requests.Session()


class HttpScorer:
    """Posts ``{"items": […]}`` and answers with the reply's ``results``.

    Use ``functools.partial(HttpScorer, endpoint, timeout_s)`` as the factory, so that
    each asking thread of a partition keeps one session and its connections. ``session`` is anything
    with the ``post`` of ``requests.Session``.
    """

    def __init__(self, endpoint: str, timeout_s: float = 30, session=None) -> None:
        self.endpoint = endpoint
        self.timeout_s = timeout_s
        self.session = session or _new_session()

    def __call__(self, items: list[dict[str, str]]) -> list[dict[str, Any]]:
        reply = self.session.post(self.endpoint, json={"items": items}, timeout=self.timeout_s)
        reply.raise_for_status()
        match reply.json():
            case {"results": results}:
                return results
            case _:
                return []


class HttpReady:
    """Readiness test for ``batch_writer``: does the service's health page answer?"""

    def __init__(self, url: str, timeout_s: float = 2, session=None) -> None:
        self.url = url
        self.timeout_s = timeout_s
        self.session = session or _new_session()

    def __call__(self) -> bool:
        try:
            return self.session.get(self.url, timeout=self.timeout_s).status_code in (200, 204)
        except Exception:
            logger.warning("no answer from %s", self.url, exc_info=True)
            return False
