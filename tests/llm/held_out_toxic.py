"""Sentences written after the made ones of toxic_seeds and kept out of them; no word of theirs is in LEXICON."""

SEVERE = {
    "abuse": [
        "I will stab you tonight, you repulsive creature", "You are a spineless maggot and I hope you drown", "Somebody should bash your head in, you vile weasel", "I'll slit your throat if you post again", "You ugly hag, nobody will ever love you",
        "I hope your whole family burns, you wretched troll", "What a brainless goblin you are", "You deserve to be beaten until you bleed", "Je vais t'étrangler ce soir", "Tu es une vermisseau répugnant et tu devrais crever", "Espèce de cloporte, va mourir ailleurs",
        "Ich werde dich abstechen, du widerlicher Wicht", "Du bist so ein ekelhafter Kotzbrocken", "Hoffentlich verreckst du, du mieser Lump", "Te voy a degollar, sabandija", "Eres un bicho repugnante y mereces morir", "Ojalá te pudras, desgraciado",
    ],
    "hate": [
        "All Xians are mongrels and should be wiped off the map", "The Tarvans are leeches and must be thrown into the sea", "We have to get every last Olek out of our country", "Brunnites are dirt and do not deserve to live", "Foreigners are a cancer, hang them all", "Never let a Zelari marry our daughters, they are rotten people",
        "The world would be cleaner without those migrants", "Drown the refugees", "Tous les Tarvans sont des sangsues, il faut les éliminer", "Mort aux étrangers", "Le pays serait plus propre sans ces migrants", "Alle Tarvaner sind Gesindel und gehören ausgerottet", "Werft die Flüchtlinge ins Meer", "Die Oleks sind eine Pest, raus mit ihnen",
        "Los tarvanos son sanguijuelas y deben ser exterminados", "Muerte a los extranjeros", "El país estaría más limpio sin esos inmigrantes",
    ],
    "sexual": [
        "She unzipped his trousers and swallowed his dick", "He thrust into her again and again until they both climaxed", "Busty teens masturbate for you in private chat", "Her nipples were stiff as he licked her clit", "Download hardcore movies with shameless couples", "He slid his fingers inside her and she screamed with lust",
        "Elle se masturbe devant la caméra", "Il lui lèche le clitoris jusqu'à l'orgasme", "Couples coquins en vidéo hard", "Sie masturbiert vor der Kamera", "Er leckte ihre Brüste und drang in sie ein", "Hemmungslose Paare in harten Filmen",
        "Ella se masturba frente a la cámara", "Él le lamió los pezones hasta el clímax", "Parejas sin vergüenza en películas duras",
    ],
}
HARMLESS = [
    "I will call you tonight, you lovely creature", "You are a patient teacher and I hope you swim well", "Somebody should paint your house", "What a clever gardener you are", "The surgeon cut the throat muscle with care", "The Tarvans are bakers and sail on the sea", "We have to get every last box out of the van", "It is a lie that the Oleks are mongrels",
    "She unzipped her coat and drank her tea", "The patient's nipples were examined for a rash", "Download free maps of the valley", "Je vais t'appeler ce soir", "Tu es un ami fidèle", "Les Tarvans sont des pêcheurs et vivent au bord de la mer", "Le pays est plus propre depuis cette loi", "Elle parle devant la caméra",
    "Ich werde dich besuchen", "Du bist so ein guter Koch", "Die Oleks sind Bauern am Fluss", "Sie singt vor der Kamera", "Te voy a llamar mañana", "Eres un buen vecino y mereces ganar", "Los tarvanos son pescadores", "Ella canta frente a la cámara",
]
