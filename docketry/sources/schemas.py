"""Schemas of landed feeds; numbers that feeds print now as text, now as numbers are read as text and cast."""

from __future__ import annotations

PAGINATION = "pagination struct<count: int, next: string>"
ACTION = "latestAction struct<actionDate: string, actionTime: string, text: string>"
BILL_ITEMS = f"bills array<struct<congress: int, number: string, type: string, title: string, originChamber: string, originChamberCode: string, updateDate: string, updateDateIncludingText: string, url: string, {ACTION.replace(' ', ': ', 1)}>>, {PAGINATION}"
BILL = (
    "bill struct<congress: int, number: string, type: string, title: string, introducedDate: string, originChamber: string, originChamberCode: string, constitutionalAuthorityStatementText: string, "
    f"policyArea: struct<name: string>, {ACTION.replace(' ', ': ', 1)}, sponsors: array<struct<bioguideId: string, district: int, firstName: string, lastName: string, fullName: string, party: string, state: string, url: string>>, "
    "legislationUrl: string, updateDate: string, updateDateIncludingText: string>"
)
COSPONSORS = f"cosponsors array<struct<bioguideId: string, firstName: string, middleName: string, lastName: string, fullName: string, district: int, party: string, state: string, isOriginalCosponsor: boolean, sponsorshipDate: string, url: string>>, {PAGINATION}"
SUBJECTS = f"subjects struct<legislativeSubjects: array<struct<name: string, updateDate: string>>, policyArea: struct<name: string>>, {PAGINATION}"
TEXT_VERSIONS = "textVersions array<struct<date: string, type: string, formats: array<struct<type: string, url: string>>>>"
MEMBER_ITEMS = f"members array<struct<bioguideId: string, name: string, partyName: string, state: string, district: int, depiction: struct<imageUrl: string>, terms: struct<item: array<struct<chamber: string, startYear: int>>>, updateDate: string, url: string>>, {PAGINATION}"
MEMBER = (
    "member struct<bioguideId: string, birthYear: string, firstName: string, lastName: string, directOrderName: string, invertedOrderName: string, honorificName: string, depiction: struct<imageUrl: string>, officialWebsiteUrl: string, "
    "partyHistory: array<struct<partyAbbreviation: string, partyName: string, startYear: int>>, terms: array<struct<chamber: string, congress: int, startYear: int, endYear: int, memberType: string, stateCode: string, stateName: string, district: int>>, updateDate: string>"
)
AMENDMENT_ITEMS = f"amendments array<struct<congress: int, number: string, type: string, description: string, updateDate: string, url: string>>, {PAGINATION}"
AMENDMENT = (
    "amendment struct<congress: int, number: string, type: string, chamber: string, description: string, purpose: string, amendedBill: struct<congress: int, number: string, type: string>, "
    f"amendedAmendment: struct<congress: int, number: string, type: string, url: string>, sponsors: array<struct<bioguideId: string, name: string, url: string>>, submittedDate: string, proposedDate: string, {ACTION.replace(' ', ': ', 1)}, updateDate: string>"
)
HOUSE_VOTE_ITEMS = (
    "houseRollCallVotes array<struct<congress: int, identifier: string, rollCallNumber: int, sessionNumber: int, startDate: string, updateDate: string, result: string, voteType: string, "
    f"legislationNumber: string, legislationType: string, legislationUrl: string, sourceDataURL: string, url: string>>, {PAGINATION}"
)
HOUSE_VOTE_MEMBERS = (
    "struct<congress: int, identifier: string, rollCallNumber: int, sessionNumber: int, startDate: string, updateDate: string, result: string, voteType: string, voteQuestion: string, legislationNumber: string, "
    "legislationType: string, legislationUrl: string, sourceDataURL: string, results: array<struct<bioguideID: string, firstName: string, lastName: string, voteCast: string, voteParty: string, voteState: string>>>"
)
SENATE_VOTE = (
    "congress int, session int, vote_number int, vote_date string, question string, vote_result string, result string, document struct<document_congress: string, document_type: string, document_number: string, document_name: string, document_title: string, document_short_title: string>, "
    "amendment struct<amendment_number: string, amendment_to_document_number: string>, members struct<member: array<struct<lis_member_id: string, first_name: string, last_name: string, party: string, state: string, vote_cast: string>>>, _corrupt_record string"
)
SENATE_MENU = "vote_number string, vote_date string, issue string, question string, result string, en_bloc string, vote_tally struct<yeas: string, nays: string>, title string"
SENATOR_LOOKUP = (
    "lisid string, bioguide string, full_name struct<first_name: string, middle_name: string, last_name: string>, party string, state string, congresses struct<congress: array<string>>, "
    "service_dates struct<service_date: array<struct<_class: string, begin_date: struct<_congress: string, _day: string, _month: string, _year: string>, end_date: struct<_congress: string, _day: string, _month: string, _year: string>>>>"
)
HOUSE_MEMBER = (
    "`member-info` struct<bioguideID: string, firstname: string, lastname: string, party: string, state: struct<`state-fullname`: string>, district: string>, "
    "`committee-assignments` struct<committee: array<struct<_comcode: string, _code: string, _name: string, _rank: string, _side: string>>, subcommittee: array<struct<_subcomcode: string, _code: string, _name: string, _rank: string, _side: string>>>"
)
SENATE_IDENTITY = "_bioguide_id string, _lis_member_id string, bioguide_id string, lis_member_id string, first_name string, last_name string, party string, state string, committees struct<committee: array<struct<_code: string, _VALUE: string>>>"
SENATE_ROSTER = "committees struct<committee_name: string, committee_code: string, members: struct<member: array<struct<name: struct<first: string, last: string>, state: string, party: string, position: string>>>, subcommittee: array<struct<subcommittee_name: string, committee_code: string, members: struct<member: array<struct<name: struct<first: string, last: string>, state: string, party: string, position: string>>>>>>"
