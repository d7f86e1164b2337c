"""A small staging area with documents of several kinds."""

SCHEMA_ROOT = "https://schemas.example.org"


def schema(name):
    return f"{SCHEMA_ROOT}/{name}"


SCHEMAS = [
    (schema("protocol"), '{"type": "object", "required": ["computational_method"], "properties": {"describedBy": {"type": "string"}}}'),
    (schema("any"), '{"type": "object"}'),
    (schema("links"), '{"type": "object", "required": ["schema_type"]}'),
    (schema("descriptor"), '{"type": "object", "required": ["file_version"]}'),
]

V1 = "2021-05-24T12:00:00.000000Z"
V2 = "2021-08-06T14:35:06.273000Z"


def descriptor(file_id, name, crc="c1", **extra):
    body = {"describedBy": schema("descriptor"), "file_name": name, "file_id": file_id, "file_version": "1", "crc32c": crc}
    return {**body, **extra}


def process_link(process="proc1", inputs=("cell1",), outputs=("file1",), protocols=("prot1",)):
    return {
        "link_type": "process_link", "process_type": "analysis_process", "process_id": process,
        "inputs": [{"input_type": "cell_line", "input_id": i} for i in inputs],
        "outputs": [{"output_type": "analysis_file", "output_id": i} for i in outputs],
        "protocols": [{"protocol_type": "analysis_protocol", "protocol_id": i} for i in protocols],
    }


def file_link(project="proj1", files=("sup1",)):
    return {
        "link_type": "supplementary_file_link", "entity": {"entity_type": "project", "entity_id": project},
        "files": [{"file_type": "supplementary_file", "file_id": i} for i in files],
    }


def links(*items, **extra):
    return {"describedBy": schema("links"), "schema_type": "links", "links": list(items), **extra}


def write_area(put, area="area", version=V1):
    """A sound area: one project with a process and a supplementary file."""
    any_doc = {"describedBy": schema("any")}
    put(f"{area}/metadata/project/proj1_{version}.json", {**any_doc, "title": "Ærø"})
    put(f"{area}/metadata/analysis_process/proc1_{version}.json", any_doc)
    put(f"{area}/metadata/cell_line/cell1_{version}.json", {**any_doc, "cells": [712345678901]})
    put(f"{area}/metadata/analysis_protocol/prot1_{version}.json", {"describedBy": schema("protocol"), "computational_method": "m"})
    put(f"{area}/metadata/analysis_file/file1_{version}.json", any_doc)
    put(f"{area}/metadata/supplementary_file/sup1_{version}.json", any_doc)
    put(f"{area}/descriptors/analysis_file/file1_{version}.json", descriptor("fid1", "a/b.csv"))
    put(f"{area}/descriptors/supplementary_file/sup1_{version}.json", descriptor("fid2", "s.txt", drs_uri="drs://x"))
    put(f"{area}/links/links1_{version}_proj1.json", links(process_link(), file_link()))
    put(f"{area}/data/a/b.csv", "1,2")
