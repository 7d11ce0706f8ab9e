"""File-arrival stream: names of new files are the stream, each micro-batch a load."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidegate.contract import TableContract
from tidegate.plans.ingest import Store, ingest_batch
from tidegate.sources.files import LISTING


def ingest_arrivals(
    store: Store,
    contract: TableContract,
    folder: str,
    checkpoint: str,
    archive: str | None = None,
    files_per_batch: int = 1_000,
    on_refused: str = "skip",
    **trigger,
) -> StreamingQuery:
    """Load every file that arrives in `folder`, once.

    The checkpoint remembers files taken; a micro-batch repeated after a failure is
    recognised by its id and by the ledger. With `archive`, a file is moved there after
    its batch (the last batch's files when a later one runs).
    """
    reader = store.spark.readStream.format("binaryFile").schema(LISTING).option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    arrivals = reader.load(folder).select("path")
    # Another checkpoint counts its epochs from 0 again, so it is part of the batch id.
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:10]

    def take(files: DataFrame, epoch: int) -> None:
        # Bounded by files_per_batch; names only.
        paths = [r.path for r in files.toLocalIterator()]
        if paths:
            ingest_batch(
                store, contract, paths, f"stream-{stream}-{epoch}", datetime.now(timezone.utc).replace(tzinfo=None), on_refused
            )

    writer = arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
