from .changes import (
    OP_DELETE, TRUTHY_WORDS,
    after_image, before_image, is_json_null, is_json_text,
    image_struct_type, parse_record, record_op, safe_cast, source_metadata,
    to_variant, typed_from_struct, typed_value, variant_text,
)
from .phone import PHONE_FUNCTION, phone_function_sql, register_functions

__all__ = [
    "OP_DELETE", "TRUTHY_WORDS",
    "after_image", "before_image", "is_json_null", "is_json_text", "parse_record", "record_op", "safe_cast",
    "source_metadata", "to_variant", "typed_value", "variant_text", "image_struct_type", "typed_from_struct",
    "PHONE_FUNCTION", "phone_function_sql", "register_functions",
]
