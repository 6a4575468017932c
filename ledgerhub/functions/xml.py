"""XML text from structs and back. Values are escaped and NULL gives an empty element."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerhub.fixed_values import SOAP_HEAD, SOAP_TAIL


def element(body: Column, tag: str) -> Column:
    """A struct as one XML element without layout blanks."""
    return F.regexp_replace(F.to_xml(body, {"rowTag": tag, "nullValue": ""}), r">\n *<", "><")


def prefixed(xml: Column, tag: str, prefix: str, namespace: str) -> Column:
    """All tags under a namespace prefix, declared on the outer ``tag``.

    ``<`` only occurs at tags because values are escaped.
    """
    tagged = F.regexp_replace(xml, r"<(/?)", f"<$1{prefix}:")
    outer = f"<{prefix}:{tag}>"
    declared = f'<{prefix}:{tag} xmlns:{prefix}="{namespace}">'
    return F.concat(F.lit(declared), F.substr(tagged, F.lit(len(outer) + 1)))


def soap_message(xml: Column) -> Column:
    return F.concat(F.lit(SOAP_HEAD), xml, F.lit(SOAP_TAIL))


def parsed(text: Column, ddl: str) -> Column:
    """Message text as a struct; ``_corrupt_record`` holds text that is not well-formed."""
    return F.from_xml(text, f"{ddl}, _corrupt_record STRING", {"mode": "PERMISSIVE"})
