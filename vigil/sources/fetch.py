"""Fetching a list into a landing folder, before and apart from any query."""

from __future__ import annotations

import logging
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable

from .files import table_rows
from .hits import more_pages

log = logging.getLogger("vigil.fetch")


def fetch(url: str, retries: int = 5, timeout: float = 60, headers: dict[str, str] | None = None, backoff: float = 2, pause: Callable[[float], None] = time.sleep, opener=urllib.request.urlopen) -> bytes | None:
    """The body, or None: refused (403) and malformed requests stop at once; other failures are tried again after backoff^attempt seconds."""
    for attempt in range(1, retries + 1):
        try:
            with opener(urllib.request.Request(url, headers=headers or {}), timeout=timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            log.warning("%s answered %s", url, e.code)
            if e.code == 403:
                return None
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            log.warning("%s failed: %s", url, e)
        except ValueError as e:
            log.error("%s is no valid request: %s", url, e)
            return None
        if attempt < retries:
            pause(backoff**attempt)
    return None


def land(url: str, path: str, skip_download: bool = False, **how) -> bool:
    """Writes the body to path; with skip_download a file that is there is left. Whether path exists afterwards."""
    if skip_download and os.path.exists(path):
        return True
    body = fetch(url, **how)
    if body is None:
        return os.path.exists(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".part", "wb") as f:
        f.write(body)
    os.replace(path + ".part", path)
    return True


def land_pages(url_of: Callable[[int], str], path_of: Callable[[int], str], more: Callable[[bytes, int], bool], last: int, skip_download: bool = False, **how) -> int:
    """Pages from 0 to at most `last`, until one fails or `more` says it was the last; the number landed."""
    for page in range(last + 1):
        if not land(url_of(page), path_of(page), skip_download, **how):
            return page
        with open(path_of(page), "rb") as f:
            if not more(f.read(), page):
                return page + 1
    return last + 1


# Hits and pages of the paged lists.
HITS, LAST_HITS_PAGE, LAST_FIRMS_PAGE = 1000, 50, 199


def land_source(name: str, folder: str, skip_download: bool = False, **how) -> bool:
    """Fetches a source's list into folder/name, a file or, for paged lists, a folder with a file a page, as the readers
    want it. Whether anything is there afterwards."""
    from ..operators.monitoring import SOURCE_URLS

    url, path = SOURCE_URLS[name], os.path.join(folder, name)
    if name == "FCPA":
        return land_pages(
            lambda p: f"{url}&from={p * HITS}&hits.hits._source=true", lambda p: os.path.join(path, f"page-{p:04d}.json"), lambda body, p: more_pages(body, p, HITS), LAST_HITS_PAGE, skip_download, **how,
        ) > 0
    if name == "WORLD_BANK":
        seen: set[tuple] = set()

        def more(body: bytes, page: int) -> bool:
            rows, linked = table_rows(body.decode("utf-8", "replace"))
            before = len(seen)
            seen.update((r["name"], r["from"]) for r in rows)
            return linked and len(seen) > before

        return land_pages(lambda p: url if not p else f"{url}?page={p + 1}", lambda p: os.path.join(path, f"page-{p:04d}.html"), more, LAST_FIRMS_PAGE, skip_download, **{"retries": 3, "timeout": 30} | how) > 0
    return land(url, path, skip_download, **how)
