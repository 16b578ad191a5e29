"""The errors that a user is told of, by code."""

from __future__ import annotations


class AppError(Exception):
    code = "APP_ERROR"


class ValidationError(AppError):
    """What was asked for is not possible."""

    code = "VALIDATION_ERROR"


class ServiceError(AppError):
    """Something that the engine relies on does not do what it should."""

    code = "SERVICE_ERROR"
