"""Whether a sentence declines, learned from a small table: a linear classifier over words, pairs of words and their place.

Sentences of the table are written for this library in four languages, as what a refusal says (it declines, or excuses,
explains, offers something else or closes) and as what an answer says. Each is varied by rule. A text is judged by all
of its sentences, at any length.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import cache

import numpy as np

from inkmill.llm.lang_samples import SAMPLES

_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_TAG = re.compile(r"<[^<>]*>")
_QUOTED = re.compile(r"\"[^\"]*\"|“[^”]*”|«[^»]*»|»[^«]*«")
_END = re.compile(r"(?<=[.!?…])\s+|\n+")
#: Classes of sentences.
ANSWER, DECLINE, BESIDE = range(3)

#: Sentences that decline, by parts: each of the first is followed by each of the second (fixed values).
DECLINING = {
    "en": (
        "I can't|I cannot|I can not|I am unable to|I'm unable to|I'm not able to|I am not able to|I won't|I will not|I would rather not|I'd rather not|I must decline to|I have to decline to|I decline to|I refuse to|I'm not allowed to|I am not permitted to|I don't feel comfortable to|I'm afraid I can't|Sorry, I can't|Unfortunately I cannot|As an assistant I cannot|It isn't possible for me to|It is not possible for me to|I'm not going to|I do not want to",
        "help with that|help you with this request|assist with this|answer that question|answer this|write that|write this kind of text|write about this topic|provide that|provide this information|produce such content|create that|do that|continue with this|comply with this request|discuss that subject|fulfil this request|take part in this|share that|respond to this prompt|tell you that|offer any advice on this",
    ),
    "fr": (
        "Je ne peux pas|Je ne peux malheureusement pas|Je ne suis pas en mesure de|Il m'est impossible de|Je refuse de|Je dois refuser de|Je préfère ne pas|Je ne souhaite pas|Je ne vais pas|Désolé, je ne peux pas|Il ne m'est pas permis de|Je n'ai pas le droit de|Je me vois contraint de ne pas",
        "vous aider|vous aider avec cette demande|répondre à cette question|répondre à cela|écrire ce texte|écrire sur ce sujet|fournir cela|fournir ces informations|produire ce contenu|faire cela|continuer|traiter cette demande|parler de ce sujet|rédiger cela|donner suite",
    ),
    "de": (
        "Das kann ich|Dabei kann ich|Diese Bitte kann ich|Diesen Text kann ich|Leider kann ich das|Das darf ich|Das möchte ich|Diese Frage kann ich|Hierbei kann ich Ihnen|Damit kann ich dir|Ich kann das|Ich kann diese Anfrage|Ich darf das|Ich werde das|Ich möchte das",
        "nicht helfen|leider nicht helfen|nicht schreiben|nicht beantworten|nicht erfüllen|nicht liefern|nicht tun|lieber nicht schreiben|nicht unterstützen|nicht verfassen|nicht bearbeiten|nicht erzeugen|nicht anbieten|nicht machen",
    ),
    "es": (
        "No puedo|Lo siento, no puedo|Lamentablemente no puedo|No me es posible|No estoy en condiciones de|Debo negarme a|Me niego a|Tengo que rechazar|Prefiero no|No voy a|No quiero|No se me permite|No tengo permitido|No debo",
        "ayudar con eso|ayudarle con esta petición|responder a esa pregunta|responder a esto|escribir ese texto|escribir sobre este tema|dar esa información|producir ese contenido|hacer eso|continuar con esto|atender esta solicitud|hablar de ese asunto|redactar esto|cumplir esta petición",
    ),
}
#: What is declined, by language: verbs and objects, {w} being a word of the sample passages (fixed values).
OBJECTS = {
    "en": ("write|answer|provide|produce|create|discuss|draft|compose|give you|help with|assist with|talk about|go into|offer|describe|explain|make", "that|this|a {w}|such a {w}|the {w} you describe|the {w} you ask for|about {w} and the {w}|anything about the {w}|questions on {w}|this sort of {w}|the {w} and the {w}|on {w}"),
    "fr": ("écrire|répondre à|fournir|produire|créer|rédiger|traiter|évoquer|décrire|vous donner|composer", "cela|un tel {w}|le {w} que vous demandez|sur {w} et le {w}|ce genre de {w}|la {w}|une question sur {w}|le {w} et la {w}"),
    "de": ("über {w} und den {w}|zu {w}|einen solchen {w}|den {w}, um den Sie bitten,|diese Art von {w}|die {w}|ein {w}", "nicht schreiben|nicht helfen|nicht beantworten|nicht liefern|nicht verfassen|nicht erklären|nicht weiterhelfen|nichts schreiben"),
    "es": ("escribir|responder a|dar|producir|crear|redactar|tratar|describir|componer", "eso|un {w} así|el {w} que pide|sobre {w} y el {w}|este tipo de {w}|la {w}|una pregunta sobre {w}|el {w} y la {w}"),
}
#: Other forms with an object (fixed values).
WITH_OBJECT = """
I won't be writing about {w} and the {w}. I won't be answering questions on {w}. Writing such a {w} goes against my rules. Providing a {w} is against what I am allowed to do. The {w} you ask for is outside of what I can do. For a {w} like this one I am the wrong place to ask. {w} is a matter on which I say nothing. A {w} of this kind I don't write.
Écrire un tel {w} est contraire à mes principes. Le {w} que vous demandez dépasse mes limites. Je n'écrirai rien sur {w}. Pour un tel {w}, je ne suis pas la bonne adresse.
Einen {w} dieser Art schreibe ich nicht. Über {w} und den {w} gebe ich keine Auskunft. Ein solcher {w} geht gegen meine Grundsätze. Für {w} bin ich nicht zuständig.
Un {w} de este tipo no lo escribo. Escribir sobre {w} va contra mis principios. El {w} que pide está fuera de mi alcance. Sobre {w} no digo nada.
""".strip().split("\n")
#: What a sentence that declines may open with (fixed values).
OPENED = {
    "en": "Sorry, |Unfortunately, |Apologies; |However, |But |I'm sorry, but |Thank you for asking, but |A kind thought, but |Having weighed it, |As an assistant, |After all, ",
    "fr": "Malheureusement, |Désolé, mais |Désolée, |Pardon, mais |Merci de votre question, mais |Hélas, |Réflexion faite, ",
    "de": "Leider: |Nach langem Nachdenken: |Entschuldigung, |Danke der Nachfrage, aber |Nein, |Verzeihung, aber ",
    "es": "Lamentablemente, |Gracias por preguntar, pero |Perdón, |Lo siento, pero |Tras pensarlo, |Por desgracia, ",
}
#: Other sentences that decline (fixed values).
DECLINING_WHOLE = """
This is something I have to turn down. I have to pass on this one. That request is one I must refuse. My answer to this is no. This goes beyond what I may do. This lies outside of what I am able to do. That is against my guidelines. This would break my rules. I must say no to this. No, I will not be writing that. I won't be answering that. This is not a task for me. You will have to ask somebody else for this. Such a text is not something I produce. Requests of this kind I turn down. I am declining this task. I'm going to have to pass. Nothing I could write here would be appropriate. I have no way of helping with this. That's not something I can do for you. I can be of no help here.
C'est contraire à mes règles. Cela dépasse ce que je peux faire. Cette demande, je dois la décliner. Ma réponse est non. Ce n'est pas une tâche pour moi. Je décline cette demande. Cela m'est interdit. C'est une chose que je ne fais pas. Il vous faudra demander à quelqu'un d'autre. Je n'écrirai pas cela. Je ne répondrai pas à cette question.
Diese Anfrage muss ich ablehnen. Das lehne ich ab. Das muss ich leider ablehnen. Das verstößt gegen meine Regeln. Das geht über meine Möglichkeiten hinaus. Dazu sage ich nein. Das ist keine Aufgabe für mich. Darauf gebe ich keine Antwort. Das liegt außerhalb dessen, was ich darf. So einen Text verfasse ich nicht. Da müssen Sie jemand anderen fragen. Diese Bitte weise ich zurück. Dazu kann ich nichts sagen.
Eso va contra mis normas. Esta petición debo rechazarla. Mi respuesta es no. No es una tarea para mí. Queda fuera de lo que puedo hacer. Rechazo esta solicitud. Eso no me corresponde. No responderé a esa pregunta. No escribiré ese texto. Tendrá que preguntar a otra persona. Es algo que no hago.
""".strip().split("\n")
#: What else a refusal says: excuses, reasons, offers, closings (fixed values).
BESIDES = """
I'm sorry. Sorry about that. I apologize for the inconvenience. My apologies. I hope you understand. Thank you for understanding. I understand this may be disappointing. My guidelines don't allow it. The topic is too sensitive. It could cause harm. It might hurt somebody. The request is not appropriate. I was made to be helpful and harmless. I'm only a language model. As an AI, I have limits. If you like, I can help with something else. Perhaps try another topic. Please ask me something different. Feel free to ask about another subject. Is there anything else I can do for you? I'd be happy to help with a different task. Let me know if you need something else. I can gladly assist with other questions. Please choose another subject. Maybe a librarian can assist you. Please contact a professional. Kind regards. Best wishes. Your assistant. Unfortunately this is the case. I appreciate your patience. The rules leave me no choice. This kind of material is not allowed here. You may want to rephrase your request.
Je suis désolé. Toutes mes excuses. Je regrette. J'espère que vous comprenez. Merci de votre compréhension. Mes règles ne le permettent pas. Le sujet est trop délicat. Cela pourrait nuire à quelqu'un. La demande n'est pas appropriée. Je ne suis qu'un modèle de langage. Je peux vous aider pour autre chose. Choisissez un autre sujet. Posez-moi une autre question. Demandez-moi autre chose. Essayez un autre sujet. Proposez autre chose. Puis-je faire autre chose pour vous ? Adressez-vous à un professionnel. Cordialement. N'hésitez pas à demander autre chose. Les consignes sont claires.
Es tut mir leid. Ich bitte um Entschuldigung. Ich bedaure das. Ich hoffe auf Ihr Verständnis. Danke für Ihr Verständnis. Meine Richtlinien erlauben es nicht. Das Thema ist zu heikel. Das könnte jemandem schaden. Die Bitte ist nicht angemessen. Ich bin nur ein Sprachmodell. Gern helfe ich bei etwas anderem. Wählen Sie bitte ein anderes Thema. Stellen Sie mir eine andere Frage. Vielleicht etwas anderes? Versuchen Sie ein anderes Thema. Kann ich sonst etwas für Sie tun? Wenden Sie sich an eine Fachperson. Mit freundlichen Grüßen. Viele Grüße. Die Regeln sind eindeutig.
Lo siento mucho. Pido disculpas. Lo lamento. Espero que lo entienda. Gracias por su comprensión. Mis normas no lo permiten. El tema es demasiado delicado. Podría hacer daño a alguien. La petición no es adecuada. Solo soy un modelo de lenguaje. Con gusto ayudo en otra cosa. Elija otro tema, por favor. Hágame otra pregunta. Pídame otra cosa. Intente con otra pregunta. Pruebe otro asunto. ¿Puedo hacer algo más por usted? Consulte a un profesional. Un saludo. Atentamente. Las reglas son claras.
""".strip().split("\n")
#: What answers say, some of it in the words of refusals (fixed values).
ANSWERS = """
She could not help laughing. He refused to open the door. They were unable to cross the river. I cannot promise a masterpiece, but here is my attempt. I can't recall her name, only the dress. We won't go home tonight. The king declined the offer. Nobody was allowed to leave. I'm sorry, said the boy, and ran. The rules of the game are simple. A good assistant listens. I would rather walk than ride. It is not possible to see the sea from here. You must not open the box, she said. First boil the water, then add the salt. Here is the poem you asked for. Of course, here is a short story. In my answer I will list three reasons. The guidelines for writing a letter are these. My policy has always been to tell the truth. One must decline an invitation politely. The request came from the mayor. I could not sleep that night. I won't forget that summer. Sure, this is how it works. Yes, the moon moves the tides. I have never seen a whale. I don't know why he left, but he took the lamp. To refuse a gift, say thank you first. I can tell you how a clock works. There was once a man who could not say no. Help yourself to bread. I was not able to find my shoes. It goes beyond words. No bird sang in the field. No sailor knew the way home. No, the lamp was never lit. No king, no crown, no bread. Not one of them spoke. Nothing moved in the house. None of us could swim.
Elle ne pouvait pas s'empêcher de rire. Il refusa d'ouvrir la porte. Je ne peux pas oublier cet été. Le roi déclina l'offre. Personne n'avait le droit de sortir. Voici le poème que vous avez demandé. D'abord faites bouillir l'eau. Les règles du jeu sont simples. Je préfère marcher. Bien sûr, voici une histoire. La demande venait du maire. Il était impossible de voir la mer. Je ne sais pas pourquoi il est parti. On ne peut pas tout avoir. Aucun oiseau ne chantait. Ni le soleil ni la lune. Rien ne bougeait.
Sie konnte nicht aufhören zu lachen. Er weigerte sich, die Tür zu öffnen. Ich kann diesen Sommer nicht vergessen. Der König lehnte das Angebot ab. Niemand durfte gehen. Hier ist das Gedicht, um das Sie baten. Zuerst das Wasser kochen. Die Regeln des Spiels sind einfach. Ich möchte lieber gehen. Natürlich, hier ist eine Geschichte. Die Bitte kam vom Bürgermeister. Man konnte das Meer nicht sehen. Ich weiß nicht, warum er ging. Das darf man nicht vergessen. Kein Vogel sang im Feld. Weder Sonne noch Mond. Nichts bewegte sich. Niemand wusste den Weg.
No podía dejar de reír. Se negó a abrir la puerta. No puedo olvidar aquel verano. El rey rechazó la oferta. Nadie podía salir. Aquí está el poema que pidió. Primero hierva el agua. Las reglas del juego son sencillas. Prefiero caminar. Claro, aquí va un cuento. La petición vino del alcalde. No se podía ver el mar. No sé por qué se fue. No se puede tener todo. Ningún pájaro cantaba. Ni el sol ni la luna. Nada se movía. Nadie sabía el camino.
""".strip().split("\n")
#: Numbers of the hashed features, rounds of training and the decay of the weights.
SIZE, ROUNDS, DECAY = 1 << 15, 300, 1e-4


def sentences(text: str) -> list[str]:
    """The sentences of a text that hold a word, without markup and quotations, in lower case."""
    own = _QUOTED.sub(" ", _TAG.sub(" ", text).replace("’", "'")).lower()
    return [s for s in _END.split(own) if _WORD.search(s)]


def features(sentence: str) -> np.ndarray:
    """Hashed words, pairs of words, pairs with a gap, and the first words with their place."""
    w = _WORD.findall(sentence)
    names = [*w, *(f"{a} {b}" for a, b in zip(w, w[1:])), *(f"{a} _ {b}" for a, b in zip(w, w[2:])), *(f"{i}:{x}" for i, x in enumerate(w[:3])), f"n{min(len(w), 12) // 3}"]
    return np.array(sorted({_hash(n) for n in names}), np.int64)


def _hash(name: str) -> int:
    return zlib.crc32(name.encode()) % SIZE


def labelled() -> tuple[list[str], list[int]]:
    """Sentences and their classes."""
    texts: list[str] = []
    classes: list[int] = []

    def add(found: list[str], kind: int) -> None:
        texts.extend(found)
        classes.extend([kind] * len(found))

    r = random.Random(3)
    words = {k: [w for w in _WORD.findall(t.lower()) if len(w) > 3] for k, t in SAMPLES.items()}

    def filled(pattern: str, language: str) -> str:
        while "{w}" in pattern:
            pattern = pattern.replace("{w}", r.choice(words[language]), 1)
        return pattern

    for language, (first, second) in DECLINING.items():
        heads = first.split("|")
        add([f"{a} {b}" for k, (a, b) in enumerate((a, b) for a in heads for b in second.split("|")) if k % 3 == 0], DECLINE)
        verbs, things = (x.split("|") for x in OBJECTS[language])
        opened = ["", "", *OPENED[language].split("|")]
        made = [filled(f"{a} {r.choice(verbs)} {r.choice(things)}", language) for a in heads for _ in range(16)]
        # de and a vowel run together
        add([re.sub(r"\bde (?=[aeiouéêèh])", "d'", r.choice(opened) + x + r.choice([".", ".", ", sorry", ""])) if language == "fr" else r.choice(opened) + x for x in made], DECLINE)
    for lines in (WITH_OBJECT, DECLINING_WHOLE):
        for line, language in zip(lines, DECLINING):
            opened = ["", *OPENED[language].split("|")]
            add([r.choice(opened) + filled(x, language) for x in _END.split(line) for _ in range(8 if lines is WITH_OBJECT else 4)], DECLINE)
    for text in SAMPLES.values():
        # answers in short lines, as in verse and lists
        w = text.split()
        add([" ".join(w[i : i + 3 + i % 5]) for i in range(0, len(w), 3)], ANSWER)
    for lines, kind in ((BESIDES, BESIDE), (ANSWERS, ANSWER)):
        found = [s for line in lines for s in _END.split(line) if s]
        add(found * (4 if kind == ANSWER else 3), kind)
    add([s for text in SAMPLES.values() for s in _END.split(text) if _WORD.search(s)] * 2, ANSWER)
    return texts, classes


@cache
def weights() -> np.ndarray:
    """(features + 1) x classes, fitted by gradient descent on the multinomial likelihood; the last row is the bias."""
    texts, classes = labelled()
    rows = [features(s) for t in texts for s in sentences(t)[:1] or [t.lower()]]
    owner, columns = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
    scale = 1 / np.sqrt(np.array([len(r) for r in rows]))
    gold = np.eye(3)[np.array(classes)]
    # classes of different sizes count alike
    share = (len(rows) / 3 / gold.sum(axis=0))[np.array(classes)][:, None]
    w, moved = np.zeros((SIZE + 1, 3)), np.zeros((SIZE + 1, 3))
    for _ in range(ROUNDS):
        score = np.stack([np.bincount(owner, weights=w[columns, k], minlength=len(rows)) for k in range(3)], axis=1) * scale[:, None] + w[SIZE]
        p = np.exp(score - score.max(axis=1, keepdims=True))
        err = (gold - p / p.sum(axis=1, keepdims=True)) * share
        step = np.stack([np.bincount(columns, weights=(err[:, k] * scale)[owner], minlength=SIZE + 1) for k in range(3)], axis=1)
        step[SIZE] = err.sum(axis=0)
        moved = 0.9 * moved + step / len(rows) - DECAY * w
        w += 4 * moved
    return w


def kind_of(sentence: str) -> int:
    """The class of one sentence, as ``sentences`` gives it."""
    w, f = weights(), features(sentence)
    return int((w[f].sum(axis=0) / np.sqrt(len(f)) + w[SIZE]).argmax())


def judged(text: str) -> list[int]:
    """The class of each sentence of a text."""
    return [kind_of(s) for s in sentences(text)]


def is_refusal(text: str) -> bool:
    """Declines and gives nothing else: a sentence declines, at most one before it says what an answer says, and of all
    words at most a third stand in such sentences, as a reason may."""
    said, kinds, before = sentences(text), [], 0
    for s in said:
        kinds.append(kind_of(s))
        before += kinds[-1] == ANSWER
        if before > 1 and DECLINE not in kinds:
            return False
    size = [len(_WORD.findall(s)) for s in said]
    return DECLINE in kinds and 3 * sum(n for n, k in zip(size, kinds) if k == ANSWER) <= sum(size)
