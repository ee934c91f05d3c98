"""Queries of the training-data operators, and the SQL of those that SQL expresses."""

from .decontaminate import OP5_SQL, op5_decontaminate
from .langid import op1_langid
from .licenses import op10_licenses
from .lines import op4_lines
from .mixing import OP3_SQL, op3_mixing
from .neighbours import OP13_SQL, op13_neighbours
from .phrases import OP11_SQL, op11_phrases
from .repeats import op6_repeats
from .search import OP12_SQL, op12_search
from .secrets import op7_secrets
from .simhash import op2_simhash
from .tiff import op9_tiff
from .tokenfiles import op8_token_files

QUERIES = {
    f.__name__: f
    for f in (
        op1_langid, op2_simhash, op3_mixing, op4_lines, op5_decontaminate, op6_repeats, op7_secrets, op8_token_files, op9_tiff, op10_licenses,
        op11_phrases, op12_search, op13_neighbours,
    )
}
SQL = {"op3_mixing": OP3_SQL, "op5_decontaminate": OP5_SQL, "op11_phrases": OP11_SQL, "op12_search": OP12_SQL, "op13_neighbours": OP13_SQL}
