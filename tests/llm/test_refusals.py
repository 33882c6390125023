"""Refusals in wording that the training table does not have, and texts that only look like refusals."""

import pytest

from inkmill.llm import pairs, refusals

FRESH = [
    "I'm going to pass on this one; it isn't the sort of thing I write.", "This prompt crosses a line for me, so I'll leave it there.", "That falls outside my remit, and I have to turn you down.", "I regret that I am in no position to answer.",
    "Nein, so etwas schreibe ich nicht. Fragen Sie bitte jemand anderen.", "Auf diese Frage werde ich nicht eingehen.", "Mit so einer Bitte bin ich leider die falsche Adresse.", "Me temo que no voy a poder responder.",
    "Esta solicitud queda fuera de lo que se me permite. Disculpe.", "Je me dois de décliner, ce genre de texte m'est interdit.", "Impossible pour moi de répondre à cela, désolé.", "Apologies, but I will have to say no to this request. I hope that is all right.",
    "I am declining. The subject is one that I do not write about, whoever asks.\n\nIf you have another question, ask it.", "Je regrette, mais je ne donnerai pas suite à votre demande.", "No, thank you. I don't do that.",
    "I must refuse. Stories of this sort are not something I make up for anyone.", "No podré ayudarle con este encargo, lo lamento.", "Dafür stehe ich nicht zur Verfügung.",
]
ANSWERS = [
    "The knight refused to kneel. He could not help it; his pride forbade it.", "I can't say who built the bridge, but the stones came from the quarry north of town, and the arches were finished in 1820.", "Roses are red\nviolets are blue\nI cannot sleep\nwithout thinking of you",
    "1. Milk\n2. Eggs\n3. Bread", "Ich kann die Berge sehen. Sie sind weit. Der Schnee liegt noch.", "No puedo dormir sin tu voz. La noche es larga. El mar no calla.", "To decline politely, thank the host, give a short reason and suggest another day.",
    "O hill, O silent hill of ours,\nno shepherd called, no dog replied;\nno lantern crossed the field at night,\nand in the well the moon had died.", "She was sorry, but the shop could not take the hat back.", "Il refusa, puis il partit. Personne ne put l'en empêcher.",
]


def test_fresh_refusals():
    missed = [f for f in FRESH if not refusals.is_refusal(f)]
    assert len(missed) <= 0.1 * len(FRESH), missed


def test_answers_are_no_refusals():
    assert [a for a in ANSWERS if refusals.is_refusal(a)] == []


def test_length_does_not_matter():
    long = "I cannot write this text. " + "I'm sorry. My guidelines don't allow it. I can help with something else. " * 40
    assert refusals.is_refusal(long) and not refusals.is_refusal(long + "The ferry left the harbour at six, and the keeper of the lamp waved from the tower. " * 200)


@pytest.mark.parametrize(("response", "defect"), [("Oui, merci.", "wrong_language"), ("Relief.", None), ("Yes, thanks.", None), ("Milk, bread, eggs.", None), ("https://example.org/weather", None)])
def test_short_answers(response, defect):
    assert pairs.defects(["What do you think about the weather in the northern countries during the long winter?"], [response]) == [defect]


@pytest.mark.parametrize("response", ["The hill is white\nthe river still\nand no one comes\nto turn the mill", "Apples\nPears\nPlums", "You will find it at https://example.org/weather"])
def test_texts_without_a_last_stop(response):
    assert pairs.defects(["Tell me about the river."], [response]) == [None]
