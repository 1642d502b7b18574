"""The two running streams: schedules to topic, topic to scored documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from delaycast.plans.features import serving_features
from delaycast.plans.model import score
from delaycast.plans.registry import LatestModel
from delaycast.schemas import MESSAGE_COLUMNS, MESSAGE_RECORD
from delaycast.sinks.documents import write_batch
from delaycast.sinks.keyed import KeyedDocuments
from delaycast.sinks.topics import to_json_batches
from delaycast.streaming.enrich import enrich_schedule
from delaycast.streaming.hot_keys import HotKeys
from delaycast.streaming.messages import message_counts, message_rows

# Fixed value: how often the producer side publishes.
PUBLISH_EVERY = "3 seconds"


def start(
    stream: DataFrame,
    deliver: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``deliver`` per micro-batch: periodically, or over everything available when ``every`` is None."""
    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def score_messages(model, messages: DataFrame, record: T.StructType = MESSAGE_RECORD) -> DataFrame:
    """Messages -> cleaned message columns plus ``delay_prob``."""
    carried = [f.name for f in record if f.name not in MESSAGE_COLUMNS]
    scored = score(model, serving_features(message_rows(messages, record)))
    return scored.select(*carried, *MESSAGE_COLUMNS, "delay_prob")


def scored_documents(
    models: LatestModel, path: str, record: T.StructType = MESSAGE_RECORD, rejects: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: score with the newest model, deliver, count rejected messages.

    Both outputs are keyed by the batch id, so a batch that runs again replaces its own files.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        model = models.get(batch.sparkSession)
        if rejects is not None:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            write_batch(message_counts(batch, record), batch_id, rejects)
        write_batch(score_messages(model, batch, record), batch_id, path)
        if rejects is not None:
            batch.unpersist()

    return deliver


def keyed_documents(
    models: LatestModel, store: KeyedDocuments, record: T.StructType = MESSAGE_RECORD, stream: str = ""
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: score with the newest model and keep the newest document of each key.

    Keys that come again replace their document; a batch that runs again changes nothing.
    """
    return store.foreach_batch(lambda batch: score_messages(models.get(batch.sparkSession), batch, record), stream)


def publish_schedules(
    schedules: DataFrame,
    airports: Callable[[], DataFrame],
    weather: Callable[[], DataFrame],
    publish: Callable[[DataFrame], None],
    checkpoint: str,
    every: str | None = PUBLISH_EVERY,
    hot: HotKeys | None = None,
) -> StreamingQuery:
    """The producer side: enrich each batch of schedules and publish it as array messages.

    The dimensions are opened anew for each batch, so it sees the newest weather. Delivery is at
    least once: a batch that failed half-way is published again. Dimensions too large to broadcast
    are joined with the hot keys of each batch split, which ``hot`` (over ``ENRICH_KEYS``) carries from
    batch to batch; without it every batch is counted first.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if hot is None:
            publish(to_json_batches(enrich_schedule(batch, airports(), weather())))
            return
        sides = airports(), weather()
        hot.deliver(
            batch_id,
            lambda splits: enrich_schedule(batch, *sides, splits=splits),
            lambda enriched: publish(to_json_batches(enriched)),
        )

    return start(schedules, deliver, checkpoint, every)
