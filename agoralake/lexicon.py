"""Word lists and name tables. They must be exactly these for results to be right."""

SPANISH_KEYWORDS = [
    "de", "la", "el", "en", "los", "las", "un", "una", "por", "con", "para", "que", "del", "al", "se", "es", "no", "su",
    "más", "pero", "colombia", "país", "gobierno", "presidente", "candidato",
]

CANDIDATE_ALIASES = {
    "el tigre": "Abelardo De la Espriella",
    "tigre": "Abelardo De la Espriella",
    "espriella": "Abelardo De la Espriella",
    "abelardo": "Abelardo De la Espriella",
    "abelardo espriella": "Abelardo De la Espriella",
    "defensores de la patria": "Abelardo De la Espriella",
    "cepeda": "Ivan Cepeda",
    "ivan cepeda": "Ivan Cepeda",
    "pacto historico": "Ivan Cepeda",
    "colombia humana": "Ivan Cepeda",
    "el cambio continua": "Ivan Cepeda",
    "firmes 2026": "Ivan Cepeda",
    "paloma": "Paloma Valencia",
    "paloma valencia": "Paloma Valencia",
    "centro democratico": "Paloma Valencia",
    "uribismo": "Paloma Valencia",
    "uribista": "Paloma Valencia",
    "oviedo": "Paloma Valencia",
    "paloma oviedo": "Paloma Valencia",
    "claudia lopez": "Claudia Lopez",
    "imparables": "Claudia Lopez",
    "caicedo": "Carlos Caicedo",
    "carlos caicedo": "Carlos Caicedo",
    "fuerza ciudadana": "Carlos Caicedo",
    "murillo": "Luis Gilberto Murillo",
    "luis gilberto": "Luis Gilberto Murillo",
    "luis gilberto murillo": "Luis Gilberto Murillo",
    "roy barreras": "Roy Barreras",
    "barreras": "Roy Barreras",
    "fuerza de la paz": "Roy Barreras",
    "lizcano": "Mauricio Lizcano",
    "mauricio lizcano": "Mauricio Lizcano",
    "botero": "Santiago Botero",
    "santiago botero": "Santiago Botero",
    "romper el sistema": "Santiago Botero",
    "fajardo": "Sergio Fajardo",
    "sergio fajardo": "Sergio Fajardo",
    "dignidad y compromiso": "Sergio Fajardo",
    "macollins": "Sondra Macollins",
    "sondra macollins": "Sondra Macollins",
    "abogada de hierro": "Sondra Macollins",
    "clara lopez": "Clara Lopez Obregon",
    "clara lopez obregon": "Clara Lopez Obregon",
    "esperanza democratica": "Clara Lopez Obregon",
    "matamoros": "Gustavo Matamoros",
    "gustavo matamoros": "Gustavo Matamoros",
    "uribe londono": "Miguel Uribe Londono",
    "miguel uribe": "Miguel Uribe Londono",
    "miguel uribe londono": "Miguel Uribe Londono",
}

CANDIDATE_PARTY = {
    "Abelardo De la Espriella": "Defensores de la Patria",
    "Ivan Cepeda": "Pacto Historico",
    "Paloma Valencia": "Centro Democratico",
    "Claudia Lopez": "Imparables",
    "Carlos Caicedo": "Fuerza Ciudadana",
    "Luis Gilberto Murillo": "Partido Verde",
    "Roy Barreras": "Fuerza de la Paz",
    "Mauricio Lizcano": "Partido de la U",
    "Santiago Botero": "Independiente",
    "Sergio Fajardo": "Dignidad y Compromiso",
    "Sondra Macollins": "Independiente",
    "Clara Lopez Obregon": "Esperanza Democratica",
    "Gustavo Matamoros": "Independiente",
    "Miguel Uribe Londono": "Centro Democratico",
}

PARTY_ALIASES = {
    "pacto historico": "Pacto Historico",
    "colombia humana": "Pacto Historico",
    "firmes 2026": "Pacto Historico",
    "centro democratico": "Centro Democratico",
    "uribismo": "Centro Democratico",
    "uribista": "Centro Democratico",
    "defensores de la patria": "Defensores de la Patria",
    "fuerza ciudadana": "Fuerza Ciudadana",
    "fuerza de la paz": "Fuerza de la Paz",
    "partido de la u": "Partido de la U",
    "partido verde": "Partido Verde",
    "imparables": "Imparables",
    "esperanza democratica": "Esperanza Democratica",
    "dignidad y compromiso": "Dignidad y Compromiso",
}

FUZZY_TARGETS = {
    "cepeda": "Ivan Cepeda",
    "espriella": "Abelardo De la Espriella",
    "abelardo": "Abelardo De la Espriella",
    "paloma": "Paloma Valencia",
    "caicedo": "Carlos Caicedo",
    "lizcano": "Mauricio Lizcano",
    "fajardo": "Sergio Fajardo",
    "macollins": "Sondra Macollins",
    "matamoros": "Gustavo Matamoros",
}

# Phrases that state a voting intention, and words that mark reporting rather than intention; all on normalised text.
INTENTION_PHRASES = [
    "voto por", "votar por", "voy a votar por", "mi voto (?:es )?(?:para|por)", "votare por", "votamos por", "vota por",
    "mi candidato", "mi candidata", "nuestro presidente", "nuestra presidenta", "que gane", "va a ganar", "va ganando",
    "ganara", "presidente en primera vuelta", "presidente de colombia",
]
REPORTING_WORDS = [
    "prediccion", "encuesta", "segun", "debate", "entrevista", "analisis", "opina", "opinion", "noticia", "que opinas",
]

FORECAST_CANDIDATES = [
    "Abelardo De la Espriella", "Ivan Cepeda", "Paloma Valencia", "Claudia Lopez", "Carlos Caicedo", "Sergio Fajardo",
    "Roy Barreras",
]
