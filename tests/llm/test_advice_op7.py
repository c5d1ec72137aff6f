
from tapewright.llm import mixing


def test_op7_topics_are_whole_words(spark):
    texts = {
        1: "The nation is mentioning an error or two, probably.",  # fragments only
        2: "The hospital and the doctor saw the patient.", 3: "Die Regierung und das Parlament", 4: "Правительство и парламент: выборы!", 5: "病院で医師が患者を診る。",
        6: "La banque, le marché", 7: "supermarkets embank", 8: "MUSIC; music_film... river", 9: None, 10: "river river music",
    }
    docs = spark.createDataFrame([(i, t, "x", "s") for i, t in texts.items()], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["topic"] for r in mixing.mix(docs).collect()}
    assert got == {1: "other", 2: "health", 3: "politics", 4: "politics", 5: "health", 6: "economy", 7: "other", 8: "culture", 9: "other", 10: "nature"}
