"""The language stage rejects what was never trained on (with enough held-out documents in every language)."""

import corpus_pipeline
from corpusloom.llm.common import table

UNKNOWN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván.",
    "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
]


def test_unknown_languages_go_and_clean_documents_stay(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    clean = docs.where("length(text) > 0").count()
    odd = docs.limit(1).drop("doc_id", "text", "lang").crossJoin(spark.createDataFrame(
        [(10 ** 6 + i, t * 6, None) for i, t in enumerate(UNKNOWN)], "doc_id long, text string, lang string")).select(docs.columns)
    kept = [r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(odd), "").select("doc_id").collect()]
    assert not [i for i in kept if i >= 10 ** 6]
    assert len(kept) > 0.99 * clean, len(kept)
