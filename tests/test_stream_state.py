"""One state and one call for the sources of a bucket."""

import pandas as pd

from alertlake.streaming.reassoc import _ORDER, LastAssociation

COLUMNS = ["alert_id", "dia_source_id", "mjd", "ss_object_id", "ss_object_reassoc_time_mjd"]


class Handle:
    """Keeps one value and the timers of one key, and counts the updates."""

    def __init__(self):
        self.value, self.updates, self.timers = None, 0, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.updates = value, self.updates + 1

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)


class Times:
    def __init__(self, watermark=0):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def made(days=None):
    handle, processor = Handle(), LastAssociation(COLUMNS, days)
    processor.init(handle)
    return handle, processor


def batch(*rows):
    """(alert, source, mjd, association)"""
    found = pd.DataFrame([(str(a), s, m, i, None, a) for a, s, m, i in rows], columns=[*COLUMNS, _ORDER])
    return iter([found])


def flags(out):
    return {int(a): (r, n) for a, r, n in pd.concat(list(out))[["alert_id", "reassociation_reason", "is_new_source"]].values}


def test_sources_of_a_bucket_share_a_call():
    handle, processor = made()
    first = flags(processor.handleInputRows((1,), batch((3, 2, 1.0, "a"), (1, 1, 1.0, None), (2, 1, 2.0, "a")), Times()))
    assert first == {1: (None, True), 2: ("new_association", False), 3: (None, True)}
    second = flags(processor.handleInputRows((1,), batch((4, 2, 3.0, "b"), (5, 1, 3.0, "a"), (6, 9, 1.0, "c")), Times()))
    assert second == {4: ("changed_association", False), 5: (None, False), 6: (None, True)}
    assert handle.updates == 2 and sorted(handle.value[0]) == [1, 2, 9]


def test_initial_state_of_a_bucket_comes_in_parts():
    handle, processor = made()
    for source, ident in ((1, "a"), (2**60 + 1, None)):
        given = {"dia_source_id": [source], "ss_object_id": [ident], "ss_object_reassoc_time": [None], "last_seen_mjd": [1.0]}
        processor.handleInitialState((1,), pd.DataFrame(given), Times())
    found = flags(processor.handleInputRows((1,), batch((1, 1, 2.0, "b"), (2, 2**60 + 1, 2.0, "a"), (3, 2**60, 2.0, "a")), Times()))
    assert found == {1: ("changed_association", False), 2: ("new_association", False), 3: (None, True)}


def test_silent_sources_of_a_bucket_expire_alone():
    day, start = 86_400_000, 40587  # MJD of 1970-01-01
    handle, processor = made(90)
    list(processor.handleInputRows((1,), batch((1, 1, start + 10.0, "a"), (2, 2, start + 50.0, "a")), Times()))
    assert handle.timers == [101 * day]
    list(processor.handleExpiredTimer((1,), Times(101 * day), None))
    assert handle.value[0] == [2] and handle.timers[-1] == 141 * day
    found = flags(processor.handleInputRows((1,), batch((3, 1, start + 105.0, "b"), (4, 2, start + 105.0, "b")), Times(101 * day)))
    assert found == {3: (None, True), 4: ("changed_association", False)}
