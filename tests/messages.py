"""Builders for message lines and catalogs."""

from __future__ import annotations


def record(stream, data, namespace=None):
    body = {"stream": stream, "data": data, "emitted_at": 1}
    if namespace is not None:
        body["namespace"] = namespace
    return {"type": "RECORD", "record": body}


def stream_state(stream, state, namespace=None):
    descriptor = {"name": stream}
    if namespace is not None:
        descriptor["namespace"] = namespace
    body = {"stream_descriptor": descriptor, "stream_state": state}
    return {"type": "STATE", "state": {"type": "STREAM", "stream": body}}


def global_state(shared, parts):
    streams = [
        {"stream_descriptor": {"name": name, "namespace": space}, "stream_state": state}
        for (name, space), state in parts.items()
    ]
    body = {"shared_state": shared, "stream_states": streams}
    return {"type": "STATE", "state": {"type": "GLOBAL", "global": body}}


def log(text):
    return {"type": "LOG", "log": {"level": "INFO", "message": text}}


def stream(name, properties, namespace=None, modes=("full_refresh", "incremental")):
    result = {
        "name": name,
        "json_schema": {"type": "object", "properties": properties},
        "supported_sync_modes": list(modes),
    }
    if namespace is not None:
        result["namespace"] = namespace
    return result


def catalog(*streams):
    return {"type": "CATALOG", "catalog": {"streams": list(streams)}}


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


# Lines with the shape of a message that are none.
MALFORMED = [
    '{"type":"RECORD","record":{"stream":"a","data":{"id":1}}',
    '{"type":"RECORD","record":{"stream":"a","data":{"id":1}}} {"x":1}',
    '{"type":"RECORD","record":{"stream":"a","data":{"id":1}}}{"type":"LOG"}',
    '{"type":"RECORD","record":{"stream":"a"}}',
    '{"type":"RECORD","record":{"data":{}}}',
    '{"type":"RECORD"}',
    '{"type":"STATE"}',
    '{"type":"STATE","state":{"type":"STREAM","stream":{}}}',
    '{"type":"OTHER"}',
    "{}",
    "{'type':'LOG'}",
    '{"type":"LOG","log":{"x":NaN}}',
    '{"type":"LOG","log":tru}',
    '{"type":"LOG"},"m":{"type":"RECORD","record":{"stream":"a","data":{"id":1}}}',
    '{"type":"LOG"},"x":{"y":1}',
    '{"type":"LOG"}],"m":[{"type":"LOG"}',
    '{"type":"STATE","state":{"type":"GLOBAL"}}',
    '{"type":"STATE","state":{"type":"GLOBAL","global":{"stream_states":[{"stream_state":{}}]}}}',
]
