"""The pipeline's stages, each against its rule worked out by hand on what the stage before it kept."""

import corpus_pipeline
from test_operators import SMALL, components_by_hand, encoder, leaks_by_hand, word_sets

from orderlens.llm import pii
from orderlens.llm.tables import stored, table


def test_stages_follow_their_rules(spark):
    more = [(10**6, None), (10**6 + 1, "12 34 !!"), (10**6 + 2, "Mail to ann.lee@mail.example.com please, the house of the rising sun and the old mill")]
    docs = table(spark, SMALL, "documents")
    extra = spark.createDataFrame([(i, t, "en", "made", len(t or "")) for i, t in more], docs.schema)
    docs = docs.union(extra)
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: r["text"] for r in table(spark, SMALL, "benchmark").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "decontamination", "personal_data", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SMALL))
        assert out.columns == docs.columns
        found = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "language":
            want = {i: t for i, t in kept.items() if t and any(map(str.isalpha, t))}
        elif name == "near_copies":
            component = components_by_hand({i: word_sets(t, 5) for i, t in kept.items()}, 80)
            want = {i: t for i, t in kept.items() if component[i] == i}
        elif name == "decontamination":
            leaks = {d for d, _ in leaks_by_hand(kept, items)}
            want = {i: t for i, t in kept.items() if i not in leaks}
        else:
            want = found
            assert sorted(found) == sorted(kept)
            assert not any(pii.base_spans(t) for t in found.values())
            assert found[10**6 + 2].startswith("Mail to [EMAIL] please")
            untouched = [i for i, t in kept.items() if not pii.base_spans(t)]
            assert all(found[i] == kept[i] for i in untouched)
        assert found == want, name
        docs, kept = out, found
    encode = encoder()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sum(r["length"] for r in pieces) == sum(len(encode(t)) + 1 for t in kept.values())
