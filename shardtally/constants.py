"""Names and strings that occur in the event data or in the reports.

FIXED VALUES: the names, words and patterns in this file have to be spelled exactly as the
app's event export spells them, or as readers of the reports expect them. The spans at the end
are defaults.
"""

# Event names.
SCREEN_VIEW = "screen_view"
CONFIGURATION_FAILURE = "personal_id_configuration_failure"
ACCOUNT_CREATED = "personalid_account_created"
ACCOUNT_RECOVERED = "personalid_account_recovered"
MESSAGE_SENT = "personal_id_message_sent"
API_EVENTS = ("ccc_api_jobs", "ccc_api_delivery_progress", "ccc_api_learn_progress")
FUNNEL_EVENTS = (SCREEN_VIEW, CONFIGURATION_FAILURE, ACCOUNT_CREATED, ACCOUNT_RECOVERED)

# LIKE patterns over event names (the underscore is a wildcard in them).
SCREEN_VIEW_PATTERN = "%screen_view%"
NOTIFICATION_PATTERN = "%ccc_notification_type%"

# Values of event parameters.
CLICK_EVENT_TYPE = "click_notification"
NOTIFICATION_SCREEN = "PushNotificationActivity"
MESSAGE_ACTION = "ccc_message"
CLICK_ACTIONS = {
    "ccc_message_count": "ccc_message",
    "ccc_payment_count": "ccc_payment",
    "ccc_payment_info_confirmation_count": "ccc_payment_info_confirmation",
    "ccc_opportunity_summary_page_count": "ccc_opportunity_summary_page",
    "ccc_learn_progress_count": "ccc_learn_progress",
    "ccc_delivery_progress_count": "ccc_delivery_progress",
    "empty_action_count": "",
}

# What makes an event a production event.
NON_PRODUCTION_DOMAINS = ("%qa%commcarehq.org", "%test%commcarehq.org")
STAGING_SERVER = "staging.commcarehq.org"
PRODUCTION_FLAVOR = "commcare"

# How users are told apart.
DEVICE_PREFIX = "commcare_"
DEMO_USER_KEY = "is_personal_id_demo_user"

# Screens of the sign-up funnel.  Class names start after a package prefix of
# 34 characters; a name belongs to the funnel by the two words below.
SCREEN_NAME_START = 35
FUNNEL_SCREEN_WORD = "PersonalId"
NON_FUNNEL_SCREEN_WORD = "Activity"
ACTIVITY_SCREEN = "PersonalIdActivity"
PAGES = {
    "phone_page": "PersonalIdPhoneFragment",
    "biometric_page": "PersonalIdBiometricConfigFragment",
    "otp_page": "PersonalIdPhoneVerificationFragment",
    "name_page": "PersonalIdNameFragment",
    "backup_code_page": "PersonalIdBackupCodeFragment",
    "photo_page": "PersonalIdPhotoCaptureFragment",
}

# Reasons of configuration failures.
PHONE_ERRORS = (
    "start_configuration_integrity_device_failure",
    "play_services_2",
    "play_services_9",
)
BIOMETRIC_ERRORS = (
    "biometric_enrollment_failed",
    "min_biometric_hardware_absent",
    "min_biometric_hardware_unavailable",
    "min_biometric_needs_update",
)
LOCKOUT_REASON = "start_configuration_locked_account_failure"
CREATED = "created"
RECOVERED = "recovered"

# Report columns of the monthly funnel and the outcome each one counts.
OUTCOME_COLUMNS = {
    "phone": "Phone",
    "biometric": "Biometric",
    "otp": "OTP",
    "name": "Name",
    "backup_code": "Backup Code",
    "photo": "Photo",
    "phone_error": "Phone Error",
    "biometric_error": "Biometric Error",
    "locked": "Locked",
    "locked_new": "Locked (new)",
    "recovered": "Recovered",
    "created": "Created",
}
NOT_CONFIGURED = "Not configured"
WRONG_CODES_ALLOWED = 2

# Shard tables and how long they are kept.
INTRADAY_PREFIX = "events_intraday_"
FINAL_PREFIX = "events_"
SHARD_TABLE_PATTERN = "^events(_intraday)?_[0-9]{8}$"
SHARD_PATTERN = "^[0-9]{8}$"
SHARD_DAY_PATTERN = "([0-9]{8})"
RETENTION_DAYS = 180

# Default spans of the reports.
FUNNEL_WINDOW_DAYS = 30
HISTORY_MONTHS = 3
SCREEN_VIEW_HISTORY_MONTHS = 1
