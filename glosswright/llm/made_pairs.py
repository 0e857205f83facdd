"""Clauses made to train problem 1's field on: what declines, what stands around it, other languages."""

from __future__ import annotations

import random

REFUSAL = {
    "en": {
        "sorry": "||Sorry,|I'm sorry,|I apologise, but|My apologies, but|Unfortunately|Regrettably,|Thanks for asking, but|As an assistant,|As an AI,|After some thought,|I am afraid that|No,|To be honest,",
        "cannot": "I can't|I cannot|I am unable to|I'm not able to|I won't|I will not|I must refuse to|I have to decline to|I'd rather not|I am not allowed to|I'm not comfortable enough to|it is not possible for me to|my rules forbid me to|I choose not to|I am not going to|I don't feel right to|it would be wrong for me to|I was told not to|I have no permission to",
        "task": "help with this|rewrite this text|edit the passage|do what you ask|assist you here|process this content|write that|provide an output|fulfil the task|change the transcript|continue|answer this|work on it|make a version of it|comply with this request|touch this material|carry out the instruction",
        "why": "||because it goes against my guidelines|since it may be harmful|as it violates the policy|for safety reasons|because of the people named in it|as nobody gave me permission|since this is beyond what I may do|given the nature of the material",
        "whole": "This goes against my rules.|This request is not something I do.|This request falls outside of what I may do.|No output can be given for this.|The content policy prevents an answer.|I will pass on this one.|I will leave this text alone.|I refuse.|I decline.|That is off limits for me.|I have to say no to this request.|This is a request that I cannot fulfil.|Such material is not something that I edit.|You will have to find another editor for this.|There will be no version of this text from me.|It would not be appropriate to edit this.|My answer to this request is no.|Nothing can be produced from this material.|I would not feel right about it.|No rewrite was made, as this kind of material is not supported.|Nothing will be delivered for this excerpt since the policy may be violated.|The text was left as it was, for it is not allowed.|I prefer to leave this one.|I'd rather skip this one.",
    },
    "fr": {
        "sorry": "||Désolé,|Je suis désolé, mais|Je m'excuse, mais|Malheureusement|Hélas,|En tant qu'assistant,|Merci, mais|Non,|Après réflexion,", "cannot": "je ne peux pas|je ne suis pas en mesure de|je refuse de|je dois renoncer à|il m'est impossible de|je n'ai pas le droit de|je préfère ne pas|je ne vais pas|je ne souhaite pas|mes règles m'interdisent de",
        "task": "aider avec cela|réécrire ce texte|modifier ce passage|répondre à la demande|faire ce que vous demandez|traiter ce contenu|écrire cela|produire une version|continuer|vous assister", "why": "||car cela va contre mes règles|pour des raisons de sécurité|car ce contenu peut nuire|à cause des personnes citées",
        "whole": "Cette demande est contraire à mes règles.|Ma réponse est non.|Je ne touche pas à ce texte.|Ce type de contenu m'est interdit.|Je décline.|Il n'y aura pas de version de ce texte.|Je dois dire non.|Cela dépasse ce qui m'est permis.|Je laisse ce texte comme il est.",
    },
    "de": {
        "sorry": "||Entschuldigung,|Es tut mir leid,|Leider|Bedaure,|Als Assistent|Danke, aber|Nein,|Nach einigem Überlegen", "cannot": "kann ich nicht|darf ich nicht|will ich nicht|möchte ich lieber nicht|werde ich nicht|muss ich es ablehnen|ist es mir nicht erlaubt|verbieten mir meine Regeln|bin ich nicht in der Lage",
        "task": "dabei helfen|den Text umschreiben|diesen Abschnitt bearbeiten|das tun|die Anfrage erfüllen|diesen Inhalt verarbeiten|eine Fassung liefern|weitermachen|darauf antworten", "why": "||weil es gegen meine Regeln ist|aus Gründen der Sicherheit|da der Inhalt schaden kann|wegen der genannten Personen",
        "whole": "Diese Anfrage verstößt gegen meine Regeln.|Meine Antwort ist nein.|Ich lasse den Text so.|Solche Inhalte bearbeite ich nicht.|Ich lehne ab.|Diese Anfrage lehne ich ab.|Das muss ich verweigern.|Es wird keine Fassung geben.|Das geht über das hinaus, was ich darf.",
    },
    "es": {
        "sorry": "||Perdón,|Lo siento,|Disculpa, pero|Por desgracia|Lamentablemente|Como asistente,|Gracias, pero|No,|Tras pensarlo,", "cannot": "no puedo|no soy capaz de|me niego a|debo negarme a|me es imposible|no me permiten|prefiero no|no voy a|no quiero|mis reglas me prohíben",
        "task": "ayudar con esto|reescribir este texto|editar el pasaje|hacer lo que pides|atender la solicitud|procesar este contenido|escribir eso|dar una versión|continuar|responder", "why": "||porque va contra mis reglas|por razones de seguridad|ya que puede hacer daño|por las personas citadas",
        "whole": "Esta solicitud va contra mis normas.|Mi respuesta es no.|Dejo el texto como está.|Ese tipo de contenido me está prohibido.|Rechazo la petición.|No habrá versión de este texto.|Tengo que decir que no.|Eso queda fuera de lo que puedo hacer.",
    },
    "it": {"sorry": "|Mi dispiace,|Purtroppo", "cannot": "non posso|non sono in grado di|mi rifiuto di|preferisco non", "task": "aiutare con questo|riscrivere il testo|modificare il brano|continuare", "why": "|perché va contro le mie regole", "whole": "La mia risposta è no.|Questa richiesta non è ammessa."},
    "pt": {"sorry": "|Desculpe,|Infelizmente", "cannot": "não posso|não consigo|recuso-me a|prefiro não", "task": "ajudar com isso|reescrever o texto|editar a passagem|continuar", "why": "|porque vai contra as minhas regras", "whole": "A minha resposta é não.|Este pedido não é permitido."},
}
BEFORE = ["", "", "", "Hello!", "Hm.", "Note:", "Well,", "Many thanks for asking!", "Hi there.", "Response:", "Dear user,", "Okay."]
AFTER = {
    "en": ["", "", "Please send another text.", "Let me know if you need something else.", "If you like, I can give general tips.", "Is there another passage?", "You could ask someone else.", "I hope you understand.", "Happy to look at other material instead."],
    "fr": ["", "", "Envoyez un autre texte.", "Je peux donner des conseils généraux.", "Merci de votre compréhension."],
    "de": ["", "", "Bitte schicke einen anderen Text.", "Ich kann allgemeine Tipps geben.", "Danke für dein Verständnis."],
    "es": ["", "", "Envía otro texto, por favor.", "Puedo dar consejos generales.", "Gracias por tu comprensión."],
    "it": [""], "pt": [""],
}
#: Ordinary sentences of languages that are none of the corpus, to know that a text is in none of them.
OTHER_LANGUAGES = [
    "Il vecchio mulino stava vicino al fiume da molti anni. Nessuno sapeva perché il fornaio avesse lasciato la città. Alla fine fu venduto a un pittore che viveva lì.",
    "O velho moinho ficava perto do rio há muitos anos. Ninguém sabia por que o padeiro deixou a cidade. No fim foi vendido a um pintor que morava ali.",
    "De oude molen stond jarenlang bij de rivier. Niemand wist waarom de bakker de stad verliet. Uiteindelijk werd hij verkocht aan een schilder die daar woonde.",
    "Stary młyn stał nad rzeką przez wiele lat. Nikt nie wiedział, dlaczego piekarz opuścił miasto. W końcu sprzedano go malarzowi, który tam mieszkał.",
    "Старая мельница много лет стояла у реки. Никто не знал, почему пекарь покинул город. В конце концов её продали художнику.",
    "老磨坊在河边站了很多年。没有人知道面包师为什么离开了小镇。最后它被卖给了一位住在那里的画家。",
]
SAID = {"en": "“{}”, said the keeper.", "fr": "« {} », répondit le gardien.", "de": "„{}“, sagte der Wärter.", "es": "«{}», respondió el guarda."}
ENGLISH_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
ASKS = ["Reply in {}.", "Write it in {}.", "Answer in {}, please.", "The answer should be in {}.", "Use {}."]
LEAD_INS = ["", "Sure!", "Of course.", "Here is the result:", "Edited:", "Here you go.", "Result:"]


#: Longer grounds, after a declining clause.
GROUNDS = {
    "en": ["because the text names people who were never asked", "since a new version might harm those who speak in it", "as the material looks private to me", "because I was not told who owns it", "given how people could read it"],
    "fr": ["parce que le texte cite des gens qui n'ont rien demandé", "car une nouvelle version pourrait nuire à quelqu'un", "vu que ce texte me semble privé"],
    "de": ["weil der Text Menschen nennt, die niemand gefragt hat", "da eine neue Fassung jemandem schaden könnte", "denn der Inhalt wirkt privat auf mich"],
    "es": ["porque el texto nombra a gente que no fue consultada", "ya que una nueva versión podría dañar a alguien", "pues el material me parece privado"],
}
RULES = {
    "en": ["and changing it would break the rules I work by", "and that is not what I am here for", "so I leave it to someone else", "and my guidelines are clear about this"],
    "fr": ["et cela ne respecte pas mes règles", "et je laisse cela à quelqu'un d'autre"], "de": ["und das wäre gegen die Regeln, nach denen ich arbeite", "und so überlasse ich es anderen"], "es": ["y eso rompería las reglas que sigo", "así que lo dejo a otra persona"],
}


SLOTS = {language: {k: v.split("|") for k, v in slots.items()} for language, slots in REFUSAL.items()}


def refusal(rng: random.Random, language: str) -> tuple[str, str, str]:
    """(what stands before, the declining words, what stands after) in *language*."""
    slots = SLOTS[language]
    if rng.random() < 0.35:
        core = rng.choice(slots["whole"])
        if rng.random() < 0.3 and (opener := rng.choice(slots["sorry"])).endswith(","):
            core = f"{opener} {core[0].lower()}{core[1:]}"
    else:
        parts = [rng.choice(slots[k]) for k in ("sorry", "cannot", "task", "why")]
        if rng.random() < 0.15:  # the task comes first
            parts[1], parts[2] = parts[2], parts[1]
        core = " ".join(p for p in parts if p)
        if language in GROUNDS and rng.random() < 0.35:
            core = ", ".join([core, rng.choice(GROUNDS[language]), *([rng.choice(RULES[language])] if rng.random() < 0.7 else [])])
        core = core[0].upper() + core[1:] + rng.choice([".", ".", "!"])
    return rng.choice(BEFORE), core, rng.choice(AFTER[language])
