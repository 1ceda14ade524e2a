import pickle

import numpy as np

from lectern.llm import kneser_ney as kn
from lectern.llm.common import Scratch


def test_the_driver_sends_columns_only(spark):
    """Tables of the cached models are put together in tasks: what is broadcast has 22 bytes an entry."""
    texts = spark.createDataFrame([(k, f"the nation of {k * 7919 % 1000} things and {k} others") for k in range(40)], "doc long, text string")
    entries = kn.train(texts, Scratch(spark, "cached"), 2)
    cached, n = kn.cached_models(entries, 1 << 20), entries.count()
    sent = pickle.dumps(cached)
    assert len(sent) < 24 * n + 2000
    columns = kn._columns([entries.select(*kn.ENTRY).toArrow()])
    grams, _ = kn.packed_grams([b"the nation of others", b"unseen words"])
    for number, model in pickle.loads(sent).models().items():
        bits, settled = model.surprisal(grams)
        assert settled.all() and np.array_equal(bits, kn._model(columns, number, True).surprisal(grams)[0])
