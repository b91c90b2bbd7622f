"""Errors, by who has to act: the table's files are wrong or missing, the call is wrong, or it asks for what isn't offered."""


class LakeError(Exception):
    pass


class TableIOError(LakeError):
    pass


class InvalidInputError(LakeError):
    pass


class NotSupportedError(LakeError):
    pass
