"""Reading destinations that were fed at least once.

A replay from the same checkpoint overwrites what it wrote before. A relay that was
started again from a saved position, under a new checkpoint, sends the events after
that position a second time; here the copies are dropped on read. A relay that remembers
what it delivered (``streaming.delivered``) does not write them.
"""

from pyspark.sql import DataFrame


def first_delivery(events: DataFrame, key: str = "token") -> DataFrame:
    """One row per event, batch or stream.

    Copies collapse in the partial aggregate of each task, so a group of copies
    reaches the shuffle as one row per task however large it is. On a stream the
    state grows with the log, as no copy is ever too late; ``streaming.delivered`` is the
    bounded form.
    """
    return events.dropDuplicates([key])
