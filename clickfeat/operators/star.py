"""A click log that is a join of facts with sessions, devices and ads.

    facts     session_id, ad_id, cat_match, clicked
    sessions  session_id, device_id
    devices   device_id, device_ip
    ads       ad_id, query, campaign_id

All joins are inner ones, so their order is free.  Sessions that can be broadcast meet the facts one table after the
other, and the facts are not shuffled.  Larger ones meet the devices first: a join of sessions, of which there are fewer
than facts, takes the place of one of facts.  Those joins are dealt into tasks by the number of their rows (``dealt_join``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from clickfeat.operators.lookup import dealt_join, within
from clickfeat.schemas import CLICK_COLUMNS


class ClickStar(NamedTuple):
    facts: DataFrame
    sessions: DataFrame
    devices: DataFrame
    ads: DataFrame

    @property
    def small(self) -> bool:
        """Can the sessions be broadcast?"""
        return within(self.sessions)

    def rows(self) -> DataFrame:
        """The click log."""
        if self.small:
            j = self.facts.join(self.sessions, "session_id").join(self.devices, "device_id").join(self.ads, "ad_id")
        else:
            j = dealt_join(dealt_join(self.facts, self.device_sessions(), "session_id"), self.ads, "ad_id", self.facts)
        return j.select(*CLICK_COLUMNS)

    def device_sessions(self) -> DataFrame:
        """session_id, device_id, device_ip."""
        return dealt_join(self.sessions, self.devices, "device_id")
