"""Raw JSON records made from the sales facts, one shape per source.

Each is a Spark SQL expression giving one JSON text per fact row. The last
digit of the id decides what is odd about the record: a field missing, null,
blank, in quotes or of the wrong type.
"""

_HEAD = """CASE WHEN entity_id LIKE '%1' THEN concat('"name":"', entity_name, '"')
                WHEN entity_id LIKE '%2' THEN '"source_artist_name":"","name":null'
                ELSE concat('"source_artist_name":"', upper(entity_name), '","name":"other"') END"""

_SEGMENT = "split(tags, ', ')[0]"
_STATUS = "split(tags, ', ')[1]"


def _case(default: str, **by_digit: str) -> str:
    """A CASE over the last digit of the id; keys look like ``d3``."""
    whens = " ".join(
        f"WHEN entity_id LIKE '%{digit[1:]}' THEN {value}" for digit, value in by_digit.items()
    )
    return f"CASE {whens} ELSE {default} END"


def _record(*fields: str) -> str:
    return "concat('{', concat_ws(',', " + ", ".join((_HEAD, *fields)) + "), '}')"


PAYLOADS = {
    "spotify": _record(
        _case("""concat('"id":"sp', entity_id, '"')""", d3="NULL", d4="""'"id":null'"""),
        _case(
            """concat('"followers":{"total":', reach, '}')""",
            d5="NULL",
            d6="""'"followers":null'""",
            d7="""'"followers":{}'""",
        ),
        _case(
            """concat('"popularity":', score)""",
            d8="""'"popularity":""'""",
            d9="""'"popularity":"12.5"'""",
        ),
        f"""concat('"genres":["', {_SEGMENT}, '","","', {_STATUS}, '","x",{{"name":"y"}},"z"]')""",
    ),
    "lastfm": _record(
        _case("""concat('"mbid":"mb-', entity_id, '"')""", d3="""'"mbid":""'"""),
        _case(
            """concat('"stats":{"listeners":"', reach, '","playcount":"', volume, '"}')""",
            d4="""concat('"stats":{"listeners":', reach, '}')""",
            d5="NULL",
            d6="""'"stats":{"listeners":null,"playcount":"1"}'""",
        ),
        _case(
            f"""concat('"tags":{{"tag":[{{"name":"', {_SEGMENT}, '"}},{{"name":"', {_STATUS},
                '"}},{{"name":"', source, '"}},{{"name":""}},{{"name":"e"}},{{"name":"f"}}]}}')""",
            d7="NULL",
            d8="""'"tags":{"tag":""}'""",
            d9="""'"tags":""'""",
        ),
    ),
    "deezer": _record(
        """concat('"id":', entity_id)""",
        _case(
            """concat('"nb_fan":', reach)""",
            d5="""concat('"nb_fan":', reach, '.75')""",
            d6="""concat('"nb_fan":"', reach, '"')""",
            d7="NULL",
            d8="""'"nb_fan":null'""",
            d9="""'"nb_fan":"12.5"'""",
        ),
    ),
    "musicbrainz": _record(
        """concat('"id":"mb', entity_id, '"')""",
        _case(
            """concat('"rating":{"value":', floor(score / 100), '.', lpad(score % 100, 2, '0'),
                      ',"votes-count":', reach, '}')""",
            d3="""concat('"rating":{"value":"', floor(score / 100), '","votes-count":null}')""",
            d4="""concat('"rating":{"value":null,"votes-count":', reach, '}')""",
            d5="NULL",
            d6="""'"rating":null'""",
        ),
        _case(
            f"""concat('"tags":[{{"name":"', {_SEGMENT}, '","count":1}},{{"name":"', {_STATUS},
                '","count":3}},{{"name":"b","count":3}},{{"name":"c"}},{{"name":"d","count":2}},',
                '{{"name":"e","count":5}}]')""",
            d7="""'"tags":[]'""",
            d8="""'"tags":[{"count":4}]'""",
        ),
    ),
    "listenbrainz": _record(
        """concat('"artist_mbid":"mb', entity_id, '"')""",
        _case(
            """concat('"total_listen_count":', volume)""",
            d3="""'"total_listen_count":null'""",
            d4="""'"total_listen_count":""'""",
            d5="NULL",
            d6="""'"total_listen_count":"x"'""",
        ),
        _case(
            """concat('"listeners":[', array_join(array_repeat('"u"', int(reach)), ','), ']')""",
            d7="""'"listeners":[]'""",
            d8="NULL",
        ),
    ),
    "wikimedia": _record(
        _case(
            """concat('"page_title":"T ', entity_id, '"')""",
            d3="NULL",
            d4="""'"page_title":null'""",
        ),
        _case("""concat('"latest_month_views":', reach)""", d5="""'"latest_month_views":""'"""),
        _case(
            """concat('"total_window_views":"', volume, '"')""",
            d6="""'"total_window_views":"12.5"'""",
        ),
    ),
    "theaudiodb": _record(
        """concat('"idArtist":"', entity_id, '"')""",
        _case(f"""concat('"strGenre":"', {_SEGMENT}, '"')""", d6="NULL"),
        _case(
            f"""concat('"strStyle":"', {_STATUS}, '"')""",
            d3="""'"strStyle":""'""",
            d4=f"""concat('"strStyle":["a","","', {_SEGMENT}, '"]')""",
            d6="""'"strStyle":null'""",
        ),
        _case(f"""concat('"strMood":"', {_SEGMENT}, '"')""", d5="""'"strMood":"calm"'""", d6="NULL"),
    ),
    "itunes": _record(
        _case("""concat('"artistId":', entity_id)""", d3="NULL"),
        _case(
            f"""concat('"primaryGenreName":"', {_SEGMENT}, '"')""",
            d4="""'"primaryGenreName":null'""",
            d5="""'"primaryGenreName":""'""",
        ),
    ),
    "wikidata": _record(
        """concat('"id":"Q', entity_id, '"')""",
        _case(
            f"""concat('"genre_labels":["', {_SEGMENT}, '","","', {_STATUS}, '","c","d","e"]')""",
            d3="NULL",
            d4="""'"genre_labels":[]'""",
            d5="""'"genre_labels":"plain"'""",
        ),
    ),
}

# Deezer records of which every id ending in 4 is cut off in the middle.
BROKEN_DEEZER = (
    f"CASE WHEN entity_id LIKE '%4' THEN concat('{{\"id\":', entity_id, ',') "
    f"ELSE {PAYLOADS['deezer']} END"
)
