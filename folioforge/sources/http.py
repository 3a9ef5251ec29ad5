"""Pages over HTTP behind an injectable fetcher; retried, paced, landed as (url, status, html, error)."""

from __future__ import annotations

import re
import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: url -> (status, html)
Fetcher = Callable[[str], tuple[int, str]]
_BLOCKED = re.compile(r"cloudflare|attention required|just a moment", re.IGNORECASE)


class Refused(RuntimeError):
    """The server answered with a refusal; trying again at once is no use."""


def urlopen_fetcher(timeout: float = 25.0, agent: str = "Mozilla/5.0") -> Fetcher:
    def fetch(url: str) -> tuple[int, str]:
        request = urllib.request.Request(url, headers={"User-Agent": agent})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")

    return fetch


def get(url: str, fetch: Fetcher, *, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> str:
    """The page's HTML; waits 1.5^(k - 1) seconds after the k-th failure. 403, 429 and challenge pages are refusals."""
    for k in range(1, attempts + 1):
        try:
            status, html = fetch(url)
            if status in (403, 429) or (len(html) < 4000 and _BLOCKED.search(html)):
                raise Refused(f"{status} from {url}")
            if status != 200:
                raise RuntimeError(f"{status} from {url}")
            return html
        except Refused:
            raise
        except Exception:
            if k == attempts:
                raise
            sleep(1.5 ** (k - 1))
    raise AssertionError


def fetch_pages(urls: DataFrame, fetch: Fetcher, *, url_col: str = "url", delay: float = 1.5, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``urls`` with html and error (null where it went well). One request at a time in a partition, ``delay`` between.

    The number of partitions is the number of parallel requests; leave out what has landed with an anti-join.
    """
    schema = f"{url_col} string, html string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url in batch[url_col]:
                try:
                    rows.append((url, get(url, fetch, attempts=attempts, sleep=sleep), None))
                except Exception as error:
                    rows.append((url, None, str(error)))
                sleep(delay)
            yield pd.DataFrame(rows, columns=[url_col, "html", "error"])

    return urls.select(url_col).mapInPandas(run, schema)


def catalogue_links(pages: DataFrame, pattern: str = r'(?i)<a\b[^>]*\bhref="([^"]+)"') -> DataFrame:
    """(url, link): the links of landed pages, absolute, each once."""
    from folioforge.sources.files import absolute_url

    found = pages.select("url", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)))).alias("href"))
    return found.select("url", absolute_url(F.col("url"), F.col("href")).alias("link")).distinct()
