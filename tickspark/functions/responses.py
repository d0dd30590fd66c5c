"""What a response says: success, errors, class of content, status text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickspark.functions import variants as V

BUSINESS_ERROR = "HTTP 200 Business Logic Error"
#: Status codes with a text of their own.
REASONS = {
    200: "OK", 201: "Created", 204: "No Content", 301: "Moved Permanently", 302: "Found", 304: "Not Modified", 400: "Bad Request", 401: "Unauthorized",
    403: "Forbidden", 404: "Not Found", 405: "Method Not Allowed", 408: "Request Timeout", 409: "Conflict", 422: "Unprocessable Entity",
    429: "Too Many Requests", 500: "Internal Server Error", 502: "Bad Gateway", 503: "Service Unavailable", 504: "Gateway Timeout",
}


def is_success(status: Column, body: Column) -> Column:
    """Status 2xx, and no non-empty ``errors`` array in a JSON object."""
    v = V.parse(body)
    errors = V.get(v, "$.errors", "array<variant>")
    failed = V.is_object(v) & V.is_array(V.get(v, "$.errors")) & (F.size(errors) > 0)
    return F.coalesce(status.between(200, 299), F.lit(False)) & ~F.coalesce(failed, F.lit(False))


def business_error(body: Column) -> Column:
    """The first error's message, else ``error``, else ``message``, else a fixed text."""
    v = V.parse(body)
    errors = V.get(v, "$.errors")
    first = V.as_string(V.get(v, "$.errors[0].message"))
    error, message = V.as_string(V.get(v, "$.error")), V.as_string(V.get(v, "$.message"))
    told = (
        F.when(V.is_array(errors), F.coalesce(F.concat(F.lit("GraphQL Error: "), first), F.lit("GraphQL Error: Unknown")))
        .when(error.isNotNull(), F.concat(F.lit("API Error: "), error))
        .when(message.isNotNull(), F.concat(F.lit("Message: "), message))
    )
    return F.coalesce(F.when(V.is_object(v), told), F.lit(BUSINESS_ERROR))


def content_class(status: Column, body: Column, error: Column) -> Column:
    """A short text that responses of one kind share; it ends in a 16-bit hash of the body."""
    code = F.coalesce(status, F.lit(0)).cast("string")
    shown = F.substring(F.translate(body, "\n\r\t", ""), 1, 100)
    mark = F.lower(F.hex(F.xxhash64(body).bitwiseAND(F.lit(0xFFFF))))
    head = F.decode(F.substring(F.encode(error, "UTF-8"), 1, 50), "UTF-8")
    return (
        F.when(error.isNotNull(), F.concat(F.lit("ERROR: "), head))
        .when(F.coalesce(body, F.lit("")) == "", F.concat(F.lit("HTTP "), code, F.lit(" Empty")))
        .otherwise(F.concat(F.lit("HTTP "), code, F.lit(" - "), shown, F.lit(" (#"), mark, F.lit(")")))
    )


def status_label(status: Column) -> Column:
    reasons = F.create_map(*[F.lit(x) for code, text in REASONS.items() for x in (code, text)])
    return F.when(status.isNull(), "Network Error").otherwise(F.concat(status.cast("string"), F.lit(" "), F.coalesce(reasons[status.cast("int")], F.lit("Other"))))


def error_class(status: Column, error: Column, excerpt: Column) -> Column:
    """What a failed request failed by."""
    return (
        F.when(error.isNotNull(), F.substring(error, 1, 100))
        .when(status == 200, F.when(excerpt.isNotNull(), business_error(excerpt)).otherwise(BUSINESS_ERROR))
        .when(status.isNotNull(), F.concat(F.lit("HTTP "), status.cast("string")))
        .otherwise("Unknown Error")
    )


def unwrap_response(body: Column) -> tuple[Column, Column]:
    """(data as JSON, error): any ``errors`` field, even an empty one, makes an error of its messages."""
    v = V.parse(body)
    errors = V.get(v, "$.errors")
    messages = F.transform(V.get(v, "$.errors", "array<variant>"), lambda e: F.coalesce(V.as_string(V.get(e, "$.message")), F.lit("Unknown error")))
    data = V.get(v, "$.data")
    missing = F.when(v.isNull(), "invalid JSON").when(data.isNull() | V.is_null(data), "no data")
    error = F.when(errors.isNotNull() & ~V.is_null(errors), F.coalesce(F.array_join(messages, ", "), F.lit(""))).otherwise(missing)
    return F.when(error.isNull(), F.to_json(data)), error
